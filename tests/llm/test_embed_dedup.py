import numpy as np

from annotspark.llm import embed_dedup as ed


def brute(ids, vectors, threshold=0.95):
    ok = [v is not None and len(v) and None not in v and np.isfinite(np.linalg.norm(v)) and np.linalg.norm(v) > 0 for v in vectors]
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for v, o in zip(vectors, ok)]
    n, links, root = len(ids), [0] * len(ids), list(range(len(ids)))
    for a in range(n):
        for b in range(a + 1, n):
            if ok[a] and ok[b] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold:
                links[a] += 1
                links[b] += 1
                ra, rb = root[a], root[b]
                root = [ra if x == rb else x for x in root]
    least = {r: min(i for i, x in zip(ids, root) if x == r) for r in set(root)}
    return {i: (k, least[r], i == least[r]) for i, k, r in zip(ids, links, root)}


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 32))
    rows = [list(map(float, c)) for c in centres]
    for c in centres[:6]:
        rows += [list(map(float, c + rng.standard_normal(32) * s)) for s in (0.05, 0.1, 0.15, 0.2, 0.25)]
    rows += [rows[0]] * 300 + [list(map(float, centres[1] + rng.standard_normal(32) * 0.05)) for _ in range(300)]
    rows += [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] + [1.0] * 31]
    ids = [7 * k % 1009 for k in range(len(rows))]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in zip(ids, rows)], "vec_id long, embedding array<double>, label int, unit string")
    want = brute(ids, rows)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in ed.near_duplicates(df).collect()}
    assert len(got) == len(want)
    wanted, found = sum(w[0] for w in want.values()), sum(g[0] for g in got.values())
    assert found >= 0.95 * wanted
    assert all(g[0] <= want[i][0] for i, g in got.items())
    assert sum(g[1] == want[i][1] for i, g in got.items()) >= 0.99 * len(want)


def test_widths_sizes_and_repeats(spark):
    """Vectors of several lengths in one batch, very large and small components, repeated and null ids."""
    rows = [
        (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0, 0.0]), (4, [2.0, 0.0, 0.0]), (5, [1.0]), (5, [1.0]), (6, [1e300, 1e300]), (7, [1e-300, 1e-300]),
        (8, [1.0, float("nan"), 1.0]), (9, [1.0, None]), (10, []), (11, None), (12, [0.0, 0.0]), (None, [0.0, 1.0]), (None, [0.0, 1.0]), (13, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, "x", 2) for i, v in rows], "vec_id long, embedding array<double>, cls string, linked int")
    for docs in (df.coalesce(1), df.repartition(5)):
        got = sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in ed.near_duplicates(docs).collect())
        alone = [(str(i), 0, str(i)) for i in (8, 9, 10, 11, 12, 13)]
        assert got == sorted([("1", 1, "1"), ("2", 1, "1"), ("3", 1, "3"), ("4", 1, "3"), ("5", 1, "5"), ("5", 1, "5"), ("6", 1, "6"), ("7", 1, "6"), ("None", 1, "None"), ("None", 1, "None"), *alone])


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 8)
    monkeypatch.setattr(ed, "GROUP", 20)
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(16)
    rows = [list(map(float, centre + rng.standard_normal(16) * 0.02)) for _ in range(150)] + [list(map(float, rng.standard_normal(16))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    want = brute(list(range(len(rows))), rows)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in ed.near_duplicates(df).collect()} == want


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert ed.near_duplicates(df).count() == 0


def test_plan_grows_slowly():
    assert ed.plan(1000)[0] < ed.plan(10**9)[0] < 40
