import random
import re

import numpy as np

from annotspark.llm import ngram_join as nj

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """By inverted index: all pairs that share a shingle are compared."""
    sets = [sets_of(t) for _, t in rows]
    where, root = {}, list(range(len(rows)))

    def top(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for k, s in enumerate(sets):
        for j in {j for g in s for j in where.get(g, ())}:
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                root[top(k)] = top(j)
        for g in s:
            where.setdefault(g, []).append(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted((str(i), len(sets[k]), str(least.get(top(k)))) for k, (i, _) in enumerate(rows))


def got(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def test_sample_and_tricky(sample, tricky):
    for docs in (sample, tricky):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        assert got(nj.link_components(docs)) == brute(rows)


def test_chains_and_shared_passages(spark, monkeypatch):
    """Copies edited a little at a time, so that links form chains, and a passage shared by unrelated documents."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(500)]
    passage = [rng.choice(vocab) for _ in range(40)]
    rows, k = [], 0
    for _ in range(12):
        text = [rng.choice(vocab) for _ in range(rng.randint(8, 90))]
        for _ in range(12):
            rows.append((k, " ".join(text)))
            k += 1
            text = list(text)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
    for n in range(60):
        rows.append((k, " ".join(passage + [rng.choice(vocab) for _ in range(n % 30)])))
        k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for cell, pivots, common, crowd in ((4, 2, 50, 16), (1, 3, 0, 16), (2048, 2, 0, 1)):
        monkeypatch.setattr(nj, "CROWD", crowd)
        monkeypatch.setattr(nj, "CELL", cell)
        monkeypatch.setattr(nj, "PIVOTS", pivots)
        monkeypatch.setattr(nj, "COMMON", common)
        assert got(nj.link_components(df)) == want


def test_words_are_told_apart_wherever_texts_are_cut(monkeypatch):
    import pyarrow as pa

    rng = random.Random(8)
    texts = ["", " ", "a", "A b\tC\x0bd\x0ce\rf\ng", "é É\u00a0x", "x" * 900, "Y " * 300, " lead and trail ", "\x1c\x1d one word"]
    texts += ["".join(rng.choice("abCD  \n") for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += [" ".join(texts), "q" * 500 + " " + "w " * 200, "z" * 1500 + "end a b c d e " + "Z" * 1500]
    want = [len(sets_of(t)) for t in texts]

    def run(words=5):
        return [s.tobytes() for part in nj._sliced(pa.array(texts), words) for s in part]

    whole = run()
    assert [len(s) // 8 for s in whole] == want
    same = {}
    for t, s in zip(texts, whole):
        assert same.setdefault(frozenset(sets_of(t)), s) == s
    for cut_at in (256, 61, 7):
        monkeypatch.setattr(nj, "SLICE", cut_at)
        monkeypatch.setattr(nj, "NEAR", 3)
        nj._near_letters.cache_clear()
        assert run() == whole
    nj._near_letters.cache_clear()


def test_long_words_have_one_hash_wherever_they_stand(spark):
    """A word over the end of a slice, and behind another length of text, is still the same word."""
    words = [f"{c}" * 6000 for c in "abcdefghij"] + ["k" * 200_000]
    rows = [(1, " ".join(words)), (2, " ".join(["z" * 10_000, *words])), (3, " ".join(words[2:]) + " " + "y" * 300_000)]
    found = brute(rows)
    assert [r[2] for r in found] == ["1", "1", "3"]
    assert got(nj.link_components(spark.createDataFrame(rows, "doc_id long, text string"))) == found


def test_words_that_agree_modulo_powers_of_two(spark):
    """A sequence and its complement, which have one polynomial hash modulo 2 ** 64 whatever the base."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"one two {word} three four"), (4, f"one two {other} three four")]
    found = brute(rows)
    assert [r[2] for r in found] == ["1", "2", "3", "4"]
    assert got(nj.link_components(spark.createDataFrame(rows, "doc_id long, text string"))) == found


def test_marks_never_say_more_than_is_so():
    rng = np.random.default_rng(6)
    for n, m, both in ((10, 12, 9), (300, 280, 250), (300, 300, 0), (5000, 7000, 4800), (20_000, 16_000, 15_000)):
        pool = rng.integers(0, 2**63, n + m - both).astype(np.uint64)
        a, b = pool[:n], pool[n - both :]
        assert (n + m - nj._differ(nj.marks_of(a), nj.marks_of(b))) // 2 >= both


def test_empty(spark):
    assert nj.link_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_sketch_is_gone_before_pairs_are_compared(spark):
    """First shingles and marks are most of what is on disk; of them nothing is left when later tables are written."""
    import glob

    base = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{base}/sketch-*"))
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h"), (3, "q r s t u v"), (4, None)]
    found = nj.link_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(found) == brute(rows)
    assert set(glob.glob(f"{base}/sketch-*")) == before
