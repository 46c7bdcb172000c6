"""Whole sequences against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from annotspark.plans import sequences


def protein_of(seq):
    code = sequences.codons()
    seq = seq.upper()
    out = "".join(code.get(seq[i : i + 3], "X") for i in range(0, len(seq) - len(seq) % 3, 3))
    return out[:-1] if out.endswith("*") else out


@pytest.fixture(scope="module")
def long_seqs():
    r = random.Random(1)
    long = "".join(r.choice("ACGTacgt") for _ in range(9001))
    coding = "".join(r.choice(["GCT", "gaa", "NNA", "CTG"]) for _ in range(40_100))
    return {1: "", 2: "AT", 3: "ATGTAA", 4: "ATG\nTGACC", 5: long, 6: coding, 7: "GCT" * 2000 + "TAA" + "GCT" * 500 + "TGA"}


def test_whole_sequences_are_translated(spark, long_seqs):
    seqs = spark.createDataFrame(list(long_seqs.items()), "seq_id long, seq string")
    want = {i: protein_of(s) for i, s in long_seqs.items()}
    assert {r["seq_id"]: r["protein"] for r in sequences.p06(seqs).collect()} == want
    stops = {i: [k for k, c in enumerate(p[:-1]) if c == "*"] for i, p in want.items()}
    got = {r["seq_id"]: (r["n"], r["first"], r["last"]) for r in sequences.p08(seqs).collect()}
    assert got == {i: (len(s), s[0] if s else None, s[-1] if s else None) for i, s in stops.items()}
    cleaned = {r["seq_id"]: (r["cleaned"], r["reason"]) for r in sequences.p09(seqs).collect()}
    assert {i: c for i, (c, _) in cleaned.items()} == {i: p.split("*")[0] for i, p in want.items()}
    assert cleaned[6][1] == "too_long" and cleaned[7] == ("A" * 2000, "looks_like_dna")  # more than 80 % of A, C, G and T
    inside = sequences.v07(seqs.where("seq_id IN (3, 7)")).first()
    assert (inside["proteins"], inside["with_stops"], inside["short"], inside["odd"]) == (2, 1, 1, 0)


def test_a_filtered_protein_is_translated_once(spark):
    seqs = spark.createDataFrame([(1, "ATGGCTTAA"), (2, None), (3, "ATGé GCTtga"), (4, "")], "k int, seq string")
    rows = seqs.select("k", sequences.translate(F.col("seq")).alias("p")).where("length(p) >= 0")
    assert {r["k"]: r["p"] for r in rows.collect()} == {1: "MA", 3: "MXL", 4: ""}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
