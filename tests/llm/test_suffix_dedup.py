import random

import numpy as np
import pytest

from annotspark.llm import suffix_dedup as sd


def got(df):
    return sorted(map(str, (tuple(r) for r in sd.digest(sd.dedup(df)).collect())))


def test_prefix_bounds_against_direct():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(1, 3, 300), rng.integers(1, 3, 300)]).astype(np.int16)
    text[300:420] = text[:120]
    text[-1] = 0
    order = sd.suffix_order(text, 64)
    found = sd.prefix_bounds(text, order, 50)
    raw = text.astype(np.uint8).tobytes()
    for k in range(1, len(order)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert found[k] == min(n, 50)


def test_sample_and_tricky(sample, tricky):
    for docs in (sample, tricky):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        assert got(docs) == sorted(map(str, sd.brute_force(rows)))


@pytest.mark.parametrize("block", [1 << 18, 600])
def test_passages_in_many_documents(spark, monkeypatch, block):
    monkeypatch.setattr(sd, "BLOCK", block)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (9, 12, 30, 60)]
    rows = []
    for k in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(" ".join(word() for _ in range(rng.randint(0, 15))))
            p = rng.choice(passages)
            cut = rng.randrange(len(p) // 2)
            parts.append(p[cut : cut + rng.randint(20, len(p))])
        rows.append((rng.randrange(100) if k % 9 else None, "".join(parts)))
    rows += [(500 + k, "x" * 200) for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == sorted(map(str, sd.brute_force(rows)))


def test_periodic_and_ruled_texts(spark, monkeypatch):
    """Long texts of one letter, of a short period and of dashed rules, worked on in pieces and cut into fragments."""
    rule = "+" + "-" * 12 + "+" + "-" * 30 + "+"
    rows = [
        (1, "a" * 5_000_000),
        (2, "x" + "a" * 3_000 + "y"),
        (3, "ab" * 40_000),
        (4, "ba" * 300 + "c"),
        (5, "\n".join([rule, "| one | two |"] * 900)),
        (6, "\n".join([rule, "| three | four |"] * 50)),
        (7, "-" * 49),
        (8, "-" * 50 + "=" * 60),
        (9, "=" * 55),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, sd.brute_force(rows)))
    assert got(df) == want
    monkeypatch.setattr(sd, "WINDOWS", 64)
    monkeypatch.setattr(sd, "SLICE", 5_000)
    monkeypatch.setattr(sd, "HELD", 100)
    assert got(df) == want


def test_fragments_cover_every_window_once():
    """Pieces of any length, and keys that depend on a window's bytes alone."""
    rng = np.random.default_rng(3)
    pieces = [rng.integers(97, 97 + k, n).astype(np.uint8) for k, n in ((2, 400), (26, 900), (3, 49), (1, 120), (4, 50), (26, 0))]
    data, owner = np.concatenate(pieces), np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    of, start, windows, key, _ = sd.fragments(data, owner)
    keys = {}
    seen = np.zeros(len(data), dtype=int)
    for a, n, k in zip(start.tolist(), windows.tolist(), key.tolist()):
        seen[a : a + n] += 1
        for j in range(a, a + n):
            assert keys.setdefault(data[j : j + 50].tobytes(), k) == k
    whole = np.zeros(len(data), dtype=int)
    whole[: len(data) - 49] = owner[: len(data) - 49] == owner[49:]
    assert (seen == whole).all()


def test_rows_of_one_id_and_one_text(spark):
    text = "the quick brown fox jumps over the lazy dog, and then it does so again. "
    rows = [(1, text), (2, text * 2), (2, text * 2), (2, text + "tail"), (None, text), (None, text * 2), (None, text), (3, None), (3, "")]
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == sorted(map(str, sd.brute_force(rows)))


def test_one_passage_in_a_third_of_all_texts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(2, 8)))
    passage = " ".join(word() for _ in range(40))
    rows = [(k, " ".join(word() for _ in range(20)) + (passage[k % 7 :] if k % 3 == 0 else "") + word()) for k in range(900)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(16)) == sorted(map(str, sd.brute_force(rows)))


def test_filters_of_any_number_of_tasks(spark, monkeypatch):
    from annotspark.llm import filters

    values = spark.range(40_000, numPartitions=9).selectExpr("xxhash64(id) AS v")
    rows = np.array([r["v"] for r in values.collect()], dtype=np.int64)
    other = np.array([r["v"] for r in spark.range(10**6, 10**6 + 40_000).selectExpr("xxhash64(id) AS v").collect()], dtype=np.int64)
    monkeypatch.setattr(filters, "FAN", 2)
    bits = filters.filter_bits(values)
    assert len(filters.hits(bits, rows)) == len(rows) and len(filters.hits(bits, other)) < 0.03 * len(other)
    assert filters.passing(values, "v", bits).count() == len(rows)
    monkeypatch.setattr(filters, "FILTER_BITS", 1 << 10)
    assert filters.filter_bits(values) is None and len(filters.hits(None, other)) == len(other)


def test_empty(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
