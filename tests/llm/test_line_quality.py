"""The line field against sums over all labellings, and held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest

import __spark_entry__
from annotspark.llm import line_quality as lq
from tests.llm.conftest import TRICKY


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(0)
    sizes = [3, 0, 1, 5, 2]
    before = np.concatenate([[0], np.cumsum(sizes)])
    emit, moves = rng.standard_normal(11), rng.standard_normal((2, 2))
    one, pairs = lq.Field(np.zeros(0), moves).passes(emit, before)
    for a, b in zip(before[:-1], before[1:]):
        ways = list(itertools.product((0, 1), repeat=b - a))
        p = np.array([np.exp(sum(emit[a + k] * y for k, y in enumerate(w)) + sum(moves[u, v] for u, v in zip(w, w[1:]))) for w in ways])
        p /= p.sum()
        for k in range(b - a):
            assert one[a + k] == pytest.approx(sum(q for q, w in zip(p, ways) if w[k]))
            if k:
                both = [sum(q for q, w in zip(p, ways) if w[k - 1 : k + 1] == (u, v)) for u in (0, 1) for v in (0, 1)]
                assert pairs[a + k] == pytest.approx(both)


def test_training_raises_the_likelihood_and_uses_neighbours():
    rng = np.random.default_rng(1)
    before = np.arange(0, 601, 6)
    y = np.repeat(rng.integers(0, 2, 100), 6)
    x = np.stack([y + rng.standard_normal(600) * 0.7, np.ones(600)], axis=1)
    field = lq.fit_field(x, before, y, np.full(100, 1 / 6))
    chain = ((field.good(x, before) > 0.5) == y).mean()
    alone = ((x @ field.weights > 0) == y).mean()
    assert chain > 0.9 > alone and field.moves[0, 0] + field.moves[1, 1] > field.moves[0, 1] + field.moves[1, 0]


def measures(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return lq._line_measures(data, np.array([0, len(data)]))


def test_line_measures():
    x, size, before = measures("Ab cd, ab\n\n  \nZZ!! zz zz\nAb cd, ab")
    assert before.tolist() == [0, 3] and size.tolist() == [7, 8, 7]
    col = lambda c: x[:, lq.MEASURES.index(c)].tolist()
    assert col("twin") == [1, 0, 1] and col("again") == [0, 1 / 3, 0] and col("bang") == [0, 0.25, 0]
    assert col("upper") == [1 / 7, 0.25, 1 / 7] and col("distinct") == [1, 2 / 3, 1] and col("length") == pytest.approx([7 / 3, 8 / 3, 7 / 3])
    assert [len(v) for v in measures("")[:2]] == [0, 0]


def test_slices_do_not_matter(spark, sample, monkeypatch):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = lq.train(sample, labels, ~lq.held_out(lq.F.col("id")))
    texts = [r["text"] for r in sample.select("text").collect()]
    whole = [model.scores(*measures(t))[0] for t in texts]
    got = {r["text"]: r["score"] for r in lq.score(sample, model, "text", "text").collect()}
    assert [got[t] for t in texts] == pytest.approx(whole)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in __spark_entry__.queries()["op11_quality_classifier"](spark, folder).collect()}
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert len(got) == n and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    rows = [r for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if got[r["doc_id"]]["held_out"]]
    assert len(rows) > 80 and np.mean([got[r["doc_id"]]["predicted"] == r["quality"] for r in rows]) > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark, tmp_path):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    turned = labels.withColumn("quality", lq.F.when(lq.held_out(lq.F.col("doc_id")), 1 - lq.F.col("quality")).otherwise(lq.F.col("quality")))
    found = []
    for k, frame in enumerate((labels, turned)):
        docs.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        frame.write.parquet(f"{tmp_path}/{k}/labels.parquet")
        found.append({r["doc_id"]: r["score"] for r in __spark_entry__.queries()["op11_quality_classifier"](spark, f"{tmp_path}/{k}").collect()})
    assert found[0] == found[1]


def test_odd_rows(spark, tmp_path):
    docs = spark.createDataFrame([(i, t, 5.0, "y") for i, t in TRICKY], "doc_id long, text string, score double, _text string")
    labels = spark.createDataFrame([(3, 1), (4, 0), (7, 0), (8, 1), (9, 1), (9, None), (None, 1), (10, 7)], "doc_id long, quality int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = __spark_entry__.queries()["op11_quality_classifier"](spark, str(tmp_path)).collect()
    assert len(got) == len(TRICKY) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1 and {r["n_lines"] for r in got if r["doc_id"] in (1, 2)} == {0}
    none = lq.train(docs, labels.limit(0), lq.F.lit(True))
    assert {r["score"] for r in lq.score(docs, none).collect()} == {0.5}
    assert lq.score(docs.limit(0), none).collect() == [] and lq.train(docs.limit(0), labels, lq.F.lit(True)).field is None
