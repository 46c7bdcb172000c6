"""Quality rules, byte pairs, license scans, packing, id files and WARC against plain Python."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from annotspark.llm import byte_bpe, license_scan, packing, quality_rules, warc, wavelet
from annotspark.llm.common import shared_dir
from annotspark.llm.tokens import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = tokenizer_path("byte_bpe_50k.tiktoken")
WORDS = tokenizer_path("word_bpe_49k.json")


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark, tricky):
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in quality_rules.ledger(tricky).collect())
    assert got == sorted((str(i), *measures(t)) for i, t in rows_of(tricky))
    assert quality_rules.ledger(tricky.limit(0)).count() == 0


def test_ablation_equals_rescoring(sample):
    book = quality_rules.ledger(sample).cache()
    whole = {r["rule"]: r["n_kept_without"] for r in quality_rules.ablation(book, "v2").collect()}
    for rule in ("few_words", "many_symbols"):
        rest = [r for r in quality_rules.RULES if r != rule]
        assert whole[rule] == quality_rules.apply_policy(book, rest).where("kept").count()


def test_byte_pairs_equal_the_library(sample, tricky):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for docs in (sample, tricky):
        got = sorted((str(r["doc_id"]), r["ids"], r["decoded_sha256"]) for r in byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect())
        want = sorted((str(i), enc.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows_of(docs))
        assert got == want


def test_runs_of_unicode_white_space_equal_the_library(spark):
    ranks = byte_bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    spaces = "\t\n\x0b\x0c\r\x85\xa0\u1680\u2000\u2003\u200a\u2028\u2029\u202f\u205f\u3000"
    texts = [f"Home{run}About us" for c in spaces for n in (1, 2, 4, 8) for run in (f" {c}" * n, f"{c} " * n, f" {c}" * n + " ", c * n)]
    texts += [f"{c} a b {c}" for c in spaces] + [f"a {c}" for c in spaces]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).collect()}
    assert got == {i: enc.encode_ordinary(t) for i, t in enumerate(texts)}
    assert enc.encode_ordinary("Home \xa0 \xa0 \xa0 \xa0 About") == [16060, 22686, 7994]


def test_long_and_short_pieces_merge_alike():
    enc = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    pieces = [b"ab" * n for n in range(1, 32)] + ["é".encode() * 9, b"internationalisation", bytes(range(200, 250))]
    assert [np.frombuffer(x, "<u4").tolist() for x in enc.merge_all(pieces)] == [enc.merge(p) for p in pieces]


@pytest.fixture(scope="module")
def ids():
    tok = Tokenizer.from_file(WORDS)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


def crc(x):
    return zlib.crc32(np.array(x, dtype="<u4").tobytes())


def test_packing_is_whole_and_tight(sample, tricky, ids):
    for docs, size in ((sample, 4096), (tricky, 64)):
        out = packing.pack(packing.token_pieces(docs, WORDS, 1, size), size, group_pieces=64).toPandas()
        want = []
        for i, t in rows_of(docs):
            x = [*ids(t), 1]
            want += [(str(i), k // size, k, len(x[k : k + size]), crc(x[k : k + size])) for k in range(0, len(x), size)]
        got = [("None" if i != i else str(int(i)), p, s, n, c) for i, p, s, n, c in zip(out.doc_id, out.piece, out.start, out.length, out.ids_crc32)]
        assert sorted(got) == sorted(want)
        out = out.sort_values(["sequence_id", "offset"])
        fill = out.groupby("sequence_id")["length"]
        assert fill.sum().max() <= size and (fill.cumsum() - out.length == out.offset).all()
    assert packing.pack(packing.token_pieces(sample.limit(0), WORDS, 1, 64), 64).count() == 0


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fill = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert fill == [10, 10] and bins == [0, 1, 0, 1, 1] and offsets == [0, 0, 6, 5, 8]


def test_id_files(spark, sample, tricky, ids):
    for docs in (sample, tricky.where("doc_id IS NOT NULL")):
        folder = shared_dir(spark, "wavelet")
        manifest = wavelet.write_shards(docs, WORDS, 2, folder, shard_tokens=3000)
        got = [(r["doc_id"], r["start"], r["ids"]) for r in wavelet.read_shards(manifest, folder).orderBy("start").collect()]
        assert [g[0] for g in got] == sorted(g[0] for g in got)
        at = 0
        for _, start, x in got:
            assert start == at
            at += len(x)
        assert sorted((i, x) for i, _, x in got) == sorted((i, [*ids(t), 2]) for i, t in rows_of(docs))
    folder = shared_dir(spark, "wavelet")
    assert wavelet.read_shards(wavelet.write_shards(sample.limit(0), WORDS, 2, folder), folder).count() == 0


@pytest.mark.parametrize("n", [1, 511, 512, 5000, 300_000])
def test_wavelet_matrix_queries(n):
    a = np.random.default_rng(1).integers(0, 300, n)
    a[: min(n, 3)] = 17
    lengths = [n - n // 3, n // 3] if n > 2 else [n]
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(a, lengths).to_bytes())
    step = max(1, n // 700)
    assert (w.all() == a).all() and (w.access(np.arange(0, n, step)) == a[::step]).all()
    assert w.count(17, n // 50, n - n // 5) == (a[n // 50 : n - n // 5] == 17).sum() and w.count(17, 0, n) == (a == 17).sum()
    assert (w.find(17) == np.flatnonzero(a == 17)).all() and not len(w.find(1 << 20)) and (w.find(299) == np.flatnonzero(a == 299)).all()
    assert (w.bounds() == np.cumsum(lengths)).all() and (w.document(len(lengths) - 1) == a[n - lengths[-1] :]).all()


def test_one_token_inflates_few_chunks():
    a = np.random.default_rng(2).integers(0, 50_000, 1 << 20)
    w = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(a).to_bytes())
    assert w.access([777_777])[0] == a[777_777]
    assert all(len(p._open) == 1 < len(p.chunks) for p in w.planes)


def test_warc_round_trip(spark):
    rows = [(1, "u", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "v", None), (4, "w", ""), (5, "x", "a" * 5000), (5, "x", "a" * 5000), (None, "y", "z\r\n\r\nz")]
    pages = spark.createDataFrame([(*r, "extra") for r in rows], "page_id long, url string, html string, record_type string")
    folder = shared_dir(spark, "warc")
    warc.write(pages, folder)
    back = warc.read(spark, folder)
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"]) for r in back.collect())
    assert got == [("1", "revisit", 2, 9), ("2", "response", None, 9), ("3", "revisit", 4, 0), ("4", "response", None, 0), ("5", "response", None, 5000), ("5", "response", None, 5000), ("None", "response", None, 6)]
    sha = lambda b: base64.b32encode(hashlib.sha1(b).digest()).decode()
    response = back.where("record_type = 'response'").select("payload", "payload_digest", warc.base32_sha1(F.col("payload")).alias("again")).collect()
    assert all(r["payload_digest"] == r["again"] == sha(bytes(r["payload"])) for r in response)
    assert warc.read(spark, folder, payload=False).where("record_type = 'revisit' AND page_id IN (1, 3)").count() == 2
    pushed = warc.read(spark, folder).where("record_type = 'revisit' AND page_id IN (1, 3) AND target_uri LIKE '%v'")
    plan = pushed._jdf.queryExecution().executedPlan().toString()
    assert pushed.count() == 1 and "revisit" not in plan and "EndsWith" in plan
    empty = shared_dir(spark, "warc")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0
    nulls = shared_dir(spark, "warc")
    warc.write(spark.createDataFrame([(None, "u", "same"), (None, "v", "same"), (9, "w", "same")], "page_id long, url string, html string"), nulls)
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in warc.read(spark, nulls).collect()) == [("9", "response", None), ("None", "revisit", 9), ("None", "revisit", 9)]


def test_plain_gzip_members_are_read():
    import gzip
    import io

    record = warc.make_record({"record_type": "response", "page_id": 7, "payload": b"hello"})
    found = list(warc.records(io.BytesIO(gzip.compress(record) + gzip.compress(record)), [("in", "page_id", (7,))], True))
    assert [r["payload"] for r in found] == [b"hello", b"hello"]
    assert not list(warc.records(io.BytesIO(warc.member(record)), [("in", "page_id", (8,))], True))


class Counted:
    """A stream that counts what is read from it at once and in all."""

    def __init__(self, raw):
        import io

        self.raw, self.total, self.most = io.BytesIO(raw), 0, 0

    def read(self, n=-1):
        out = self.raw.read(n)
        self.total, self.most = self.total + len(out), max(self.most, len(out))
        return out

    def tell(self):
        return self.raw.tell()

    def seek(self, at):
        return self.raw.seek(at)


def test_unwanted_records_are_passed_over():
    import gzip

    noise = np.random.default_rng(4).bytes(400_000)
    make = lambda k, payload: warc.make_record({"record_type": "response", "page_id": k, "payload": payload})
    parts = [make(k, noise if k % 2 else b"small") for k in range(8)]
    wanted = [("in", "page_id", (4, 6))]
    own = Counted(b"".join(map(warc.member, parts)))
    assert [r["payload"] for r in warc.records(own, wanted, True)] == [b"small"] * 2 and own.total < 20_000
    assert [r["page_id"] for r in warc.records(Counted(b"".join(map(warc.member, parts))), [], False)] == list(range(8))
    for raw in (b"".join(map(gzip.compress, parts)), gzip.compress(b"".join(parts)), warc.member(parts[0]) + b"".join(map(gzip.compress, parts[1:]))):
        other = Counted(raw)
        assert [r["payload"] for r in warc.records(other, wanted, True)] == [b"small"] * 2 and other.most <= 1 << 16
        assert [len(r["payload"]) for r in warc.records(Counted(raw), [], True)] == [5, 400_000] * 4


def test_broken_records():
    import gzip
    import io

    good = warc.make_record({"record_type": "response", "page_id": 7, "payload": b"hello"})
    odd = good.replace(b"7", b"seven", 1)
    assert [r["page_id"] for r in warc.records(io.BytesIO(gzip.compress(b"noise\r\n\r\n" + odd + good)), [], True)] == [None, 7]
    for raw in (gzip.compress(good + good[:-12]), gzip.compress(good) + gzip.compress(good)[:-30], warc.member(good) + warc.member(good)[:-30], warc.member(good) + b"\x1f\x8b", gzip.compress(good) + b"other"):
        assert [r["payload"] for r in warc.records(io.BytesIO(raw), [], True)] == [b"hello"]
    assert not list(warc.records(io.BytesIO(b""), [], True)) and not list(warc.records(io.BytesIO(good[:9]), [], True))


def test_license_scan(spark, tricky):
    def places(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = [(i, label) for p, label in license_scan.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        return len(w), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))

    rows = {(str(r["doc_id"]), r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in license_scan.scan(tricky).collect()}
    assert rows == {(str(i), *places(t)) for i, t in rows_of(tricky)}
    text = "x " * 30 + license_scan.TEMPLATES["bsd-opening"] + " y" * 40
    one = license_scan.scan(spark.createDataFrame([(1, text), (2, "plain words of the kind")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert one[0]["labels"] == "bsd-opening" and one[0]["score"] == 1.0 and one[1]["labels"] == ""
