"""Hierarchy queries against small chains."""

from annotspark.plans import hierarchy


def test_tags_come_from_ancestors_up_to_eight_steps_away(spark):
    rows = [(k, f"n{k}", f"n{k - 1}" if k else None, "LT" if k == 0 else None) for k in range(10)]
    features = spark.createDataFrame([(k, "c", "x", 1, 9, i, p, t) for k, i, p, t in rows], "lvl int, seqid string, type string, f_start long, f_end long, id string, parent string, locus_tag string")
    got = {r["id"]: r["locus_tag"] for r in hierarchy.j03(features).collect()}
    assert got == {f"n{k}": "LT" if k <= 8 else None for k in range(10)}
