"""Hard negatives against a comparison of all rows with all."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from annotspark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, dim long, mark string"


def brute(rows, is_anchor, positives=5, negatives=3):
    """rows: (id, vector, label), as the operator takes them."""
    rows = [(i, [int(x) for x in v], lab) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, va, la in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, lab) for i, v, lab in rows if len(v) == len(va))
        for p, pid, _ in [x for x in scored if x[2] == la and x[1] != a][:positives]:
            found = [x for x in scored if x[2] != la and -50 * p <= -100 * x[0] <= -95 * p][:negatives]
            out += [(a, pid, k + 1, nid, -p, -s) for k, (s, nid, _) in enumerate(found)]
    return out


def contract(rows):
    floor = lambda v: None if v is None else [None if x is None else (math.floor(256 * np.float64(np.float32(x))) if math.isfinite(x) else x) for x in v]
    return [(i, floor(v), None if lab is None else (lab + 1) % 10 if i is not None and i % 7 == 0 else lab) for i, v, lab in rows]


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 1, None) for i, v, lab in rows], SCHEMA)


def vectors(seed, n, dim, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((4, dim))
    v = centre[rng.integers(0, 4, n)] + 0.3 * rng.standard_normal((n, dim))
    return [(i, [float(np.float32(x)) for x in row], int(lab)) for i, (row, lab) in enumerate(zip(v / np.linalg.norm(v, axis=1)[:, None], rng.integers(0, labels, n)))]


ODD = [
    (1001, None, 1), (1002, [], 1), (1003, [0.1, None, 0.2], 1), (1004, [float("nan")] * 6, 2), (1005, [float("inf")] * 6, 0), (1006, [0.1] * 6, None),
    (None, [0.1] * 6, 1), (1050, [0.5, 0.2], 1), (1051, [0.4, 0.2], 1), (1052, [0.3, 0.1], 2), (1100, [0.0] * 6, 1), (1101, [0.0] * 6, 1), (1102, [0.0] * 6, 2),
    (1150, [-1.0] * 6, 9),
]


@pytest.mark.parametrize("small", [False, True])
def test_query(spark, tmp_path, monkeypatch, small):
    if small:  # many subtrees, upper boxes and blocks
        for name, value in (("LEAF", 4), ("FAN", 3), ("TOP", 5), ("SUBTREE", (16, 16)), ("BLOCK", 3)):
            monkeypatch.setattr(hn, name, value)
    rows = vectors(1, 320, 6) + [(400 + k, [0.25] * 6, k % 2) for k in range(60)] + ODD  # many equal vectors
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = __spark_entry__.queries()["op13_hard_negatives"](spark, str(tmp_path))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(contract(rows), lambda i: i % 50 == 0)
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == sorted(want)


def test_repeated_ids_and_large_components(spark):
    rows = [(i, [float(x) for x in v], lab) for i, v, lab in [(1, [2**40, 3], 0), (1, [2**40, 3], 0), (2, [2**40 - 1, 5], 0), (3, [2**39 + 7, 1], 1), (3, [2**39 + 7, 1], 1), (4, [1.5e30, 0], 1)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = [tuple(r) for r in hn.hard_negatives(frame, F.col("id") == 1).collect()]
    # both anchors have the positive 2 and the two rows of 3; scores are exact beyond 2 ** 53 and end at the largest long
    top = (1 << 63) - 1
    p, n = min(top, 2**40 * (2**40 - 1) + 15), min(top, 2**40 * (2**39 + 7) + 3)
    assert all(r[:2] == (1, 2) and r[4] == p for r in got)
    assert p == top and n == top and got == []
    rows = [(i, [float(x) for x in v], lab) for i, v, lab in [(1, [2**30 + 1, 3], 0), (1, [2**30 + 1, 3], 0), (2, [2**30 - 1, 5], 0), (3, [2**29 + 7, 1], 1), (3, [2**29 + 7, 1], 1)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(tuple(r) for r in hn.hard_negatives(frame, F.col("id") == 1).collect())
    p, n = (2**30 + 1) * (2**30 - 1) + 15, (2**30 + 1) * (2**29 + 7) + 3
    assert got == sorted([(1, 2, k, 3, p, n) for k in (1, 2)] * 2)


def test_empty(spark):
    assert hn.hard_negatives(hn.contract_vectors(table(spark, [])), F.col("id") % 50 == 0).collect() == []
    assert hn.hard_negatives(hn.contract_vectors(table(spark, [(50, [1.0], 1)])), F.col("id") % 50 == 0).collect() == []


def test_tree_bounds_hold(monkeypatch):
    rng = np.random.default_rng(5)
    v = np.floor(256 * rng.standard_normal((700, 5)))
    monkeypatch.setattr(hn, "LEAF", 16)
    tree = hn.Tree(v, np.arange(700), np.zeros(700, dtype=np.int64))
    below, above = tree.bounds(v[:9])
    for leaf in range(tree.leaves):
        scores = tree.vectors[leaf * hn.LEAF : (leaf + 1) * hn.LEAF] @ v[:9].T
        assert (scores.min(axis=0) >= below[leaf]).all() and (scores.max(axis=0) <= above[leaf]).all()
    assert sorted(tree.ids.tolist()) == list(range(700))
    for n in range(9):
        got = tree.best(v[n], (below[:, n], above[:, n]), lambda part: tree.ids[part] != n, 7, [(-np.inf, np.inf)])[0]
        assert got == sorted(((s, i) for i, s in enumerate((v @ v[n]).tolist()) if i != n), key=lambda x: (-x[0], x[1]))[:7]
