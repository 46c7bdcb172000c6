"""Runs against a plain search over all periods, and the query's contract in plain Python."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
from annotspark.llm import periodic_runs as pr
from tests.llm.conftest import TRICKY


def brute(ws, words=6, times=4):
    best = {}
    for q in range(1, len(ws) // times + 1):
        t = 0
        while t < len(ws) - q:
            s = t
            while t < len(ws) - q and ws[t] == ws[t + q]:
                t += 1
            if t > s and t + q - s >= max(words, times * q):
                best.setdefault((s, t + q), q)
            t = max(t, s + 1) if t == s else t
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapse(ws, runs):
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(ws) if i not in drop)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_texts(seed, monkeypatch):
    monkeypatch.setattr(pr, "SLICE", 400 if seed % 2 else 1 << 20)
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(60):
        n, k = int(rng.integers(0, 160)), int(rng.integers(1, 5))
        ws = ["abcde"[x] * (1 + x) for x in rng.integers(0, k, n)]
        if n > 10 and rng.random() < 0.6:
            a, p = int(rng.integers(0, n)), int(rng.integers(1, n // 4))
            ws = ws[:a] + [ws[min(n - 1, a + (i - a) % p)] for i in range(a, n)]
        texts.append(" \n"[int(rng.integers(2))] + "  ".join(ws))
    texts += ["", " ", "a" * 5, "x " * 3000, "same words here " * 500 + "and an end", "same words here " * 500 + "and an end"]
    for text, (n, runs, collapsed) in zip(texts, pr.runs_of(pa.array(texts)), strict=True):
        ws = split(text)
        assert n == len(ws) and runs == brute(ws) and collapsed.decode() == collapse(ws, runs)


def test_extensions_agree_word_by_word():
    rng = np.random.default_rng(3)
    codes = np.concatenate([rng.integers(0, 2, 300), np.tile(rng.integers(0, 2, 7), 60), [9]])
    e = pr.Extensions(codes)
    i, j = rng.integers(0, len(codes), (2, 4000))
    i, j = i[i != j], j[i != j]
    for a, b, got in zip(i.tolist(), j.tolist(), e.agree(i, j).tolist()):
        k = 0
        while max(a, b) + k < len(codes) and codes[a + k] == codes[b + k]:
            k += 1
        assert got == k


def expected(i, text):
    ws = split(text)
    h = zlib.crc32(str(i).encode())
    if i is not None and h % 10 == 0 and ws:
        g, n = h // 10, len(ws)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if k < a else ws[a + (k - a) % p] for k, w in enumerate(ws)]
    runs = brute(ws)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    four = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (i, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(ws, runs)))


def test_query(spark, tmp_path):
    words = " ".join(f"w{k % 37}" for k in range(400))
    rows = TRICKY + [(k, words if k % 3 else "a b a b a b a b a b c " * (k % 7)) for k in range(20, 140)]
    table = spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], "doc_id long, text string, runs string, n_words long, _h string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    got = __spark_entry__.queries()["op12_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected(i, t) for i, t in rows]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_empty_and_collapsed_texts(spark, tricky):
    out = pr.periodic_runs(tricky)
    assert {r["collapsed"] for r in out.where("doc_id = 7").collect()} == {"the cat sat"}
    assert pr.periodic_runs(tricky.limit(0)).collect() == []
    assert pr.digest(pr.periodic_runs(pr.stretched(tricky.limit(0)), collapsed=False)).collect() == []
