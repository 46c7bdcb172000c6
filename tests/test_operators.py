"""Small literal cases and properties of the operators."""

import random

from pyspark.sql import functions as F

from annotspark.operators import consensus
from annotspark.operators import intervals as iv
from annotspark.plans import expression, features, formats, hits, sequences


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(1)
    make = lambda n: [(k, rng.choice("xy"), s := rng.randint(1, 900), s + rng.randint(0, 300)) for k in range(n)]
    left, right = make(80), make(70)
    a, b = spark.createDataFrame(left, "i int, seqid string, s1 int, e1 int"), spark.createDataFrame(right, "j int, seqid string, s2 int, e2 int")
    got = sorted(tuple(r) for r in iv.overlap_join(a, b, ["seqid"], "s1", "e1", "s2", "e2", width=64).select("i", "j").collect())
    assert got == sorted((i, j) for i, c, s, e in left for j, d, t, f in right if c == d and s <= f and t <= e)


def test_merge_equals_positions(spark):
    rng = random.Random(2)
    rows = [("x", s := rng.randint(1, 2000), s + rng.randint(0, 40)) for _ in range(60)]
    got = iv.merge(spark.createDataFrame(rows, "seqid string, s long, e long"), ["seqid"], "s", "e").collect()
    covered = {p for _, s, e in rows for p in range(s, e + 1)}
    assert sum(r["e"] - r["s"] + 1 for r in got) == len(covered)
    assert all(r["s"] - 1 not in covered and r["e"] + 1 not in covered for r in iv.merge(spark.createDataFrame(rows, "seqid string, s long, e long"), ["seqid"], "s", "e", gap=1).collect())
    assert len({r["s"] for r in got}) == len(got)


def test_translation_and_codes(spark):
    df = spark.createDataFrame([("ATGTGATAA",), ("atgNNN",), ("AT",)], "s string")
    got = [tuple(r) for r in df.select(sequences.translate(F.col("s")), sequences.translate(F.col("s"), 4)).collect()]
    assert got == [("M*", "MW"), ("MX", "MX"), ("", "")]
    assert sequences.codons(12)["CTG"] == "S" and sequences.codons()["CTG"] == "L"


def test_gff3_lines(spark):
    lines = ["# comment", "", "c\ts\tgene\t5\t9\t.\t+\t.\tID=a;Name=x;ID=b;flag", "c\ts\tgene\t9\t5\t.\t+\t.\tID=c", "c\ts\tgene\tx\t5\t.\t+\t.\tID=c", "too\tfew"]
    rows = formats.parse_gff3(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [r["_error"] is None for r in rows] == [True, False, False, False]
    assert rows[0]["attrs"] == {"Name": "x", "ID": "b"} and rows[0]["score"] is None


def test_adjusted_p_values(spark):
    df = spark.createDataFrame([("a", "x", 0.01), ("b", "x", 0.04), ("c", "x", 0.03), ("d", "x", None)], "id string, g string, p double")
    got = {r["id"]: round(r["padj"], 6) for r in expression.benjamini_hochberg(df, "g", "p", "id").collect()}
    assert got == {"a": 0.03, "b": 0.04, "c": 0.04}


def test_numbering_is_global(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"))
    got = features.numbered(df, [F.asc("v")], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 1001)) and [r["v"] for r in got] == sorted(r["v"] for r in got)


def test_numbering_with_further_columns(spark):
    n = 200_000
    df = spark.range(n).select((F.col("id") * 7919 % 1_000_003).alias("v"), F.col("id").alias("w"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("t"))
    got = features.numbered(df, [F.asc("v")], "n")
    assert got.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (n, 1, n)
    assert got.select("n", "v").orderBy("n").agg(F.count("*")).first()[0] == n
    rows = got.select("n", "v").toPandas().sort_values("n")
    assert (rows["v"].diff().dropna() >= 0).all()


def test_splicing_over_tiles(spark):
    rng = random.Random(7)
    seq = "".join(rng.choice("ACGT") for _ in range(200))
    contigs = spark.createDataFrame([("c", seq)], "seqid string, seq string")
    segs = [("c", k, "+-"[k % 2], s := rng.randint(1, 190), s + rng.randint(0, 60)) for k in range(12) for _ in range(3)]
    got = {r["gid"]: r["cds"] for r in formats.spliced(spark.createDataFrame(segs, "seqid string, gid int, strand string, seg_start long, seg_end long"), contigs, size=16).collect()}
    for k in range(12):
        parts = "".join(seq[s - 1 : e] for _, g, _, s, e in sorted(segs, key=lambda x: x[3:]) if g == k)
        want = parts if k % 2 == 0 else parts[::-1].translate(str.maketrans("ACGT", "TGCA"))
        assert got[k] == want


def test_annovar_rows(spark):
    rows = [("1", 10, "A", "G"), ("1", 10, "ACG", "A"), ("1", 10, "ACGT", "AT"), ("1", 10, "A", "AGG"), ("1", 10, "AC", "GT")]
    got = [tuple(r) for r in formats.annovar(spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string")).collect()]
    assert got == [("1", 10, 10, "A", "G"), ("1", 11, 12, "CG", "-"), ("1", 11, 13, "CGT", "T"), ("1", 10, 11, "-", "GG"), ("1", 10, 11, "-", "T")]


def test_redundant_contigs(spark):
    schema = "qname string, qlen long, q_start long, q_end long, tname string, tlen long, t_start long, t_end long, matches long, block long"
    whole = [("ctg2", 100, 0, 100, "ctg1", 1000, 0, 100, 98, 100)]
    partial = [("ctg3", 100, 0, 50, "ctg1", 1000, 0, 50, 49, 50)]
    as_target = [("ctg1", 1000, 0, 90, "ctg4", 90, 0, 88, 86, 120)]
    worse_first = [("ctg5", 100, 0, 100, "a", 500, 0, 100, 90, 110), ("ctg5", 100, 0, 100, "b", 500, 0, 96, 96, 97)]
    got = {r["short"]: r["long"] for r in formats.redundant_contigs(spark.createDataFrame(whole + partial + as_target + worse_first, schema)).collect()}
    assert got == {"ctg2": "ctg1", "ctg4": "ctg1", "ctg5": "b"}


def test_support_bars(spark):
    rows = [(1, 1, True, 1, 5.0, 90), (2, 1, False, 1, 5.0, 90), (3, 3, True, 1, 20.0, 91), (4, 1, True, 2, 5.0, 90)]
    df = spark.createDataFrame(rows, "gid int, n_seg int, all_ab_initio boolean, support int, score double, cds_len int")
    kept = lambda **x: [r["gid"] for r in consensus.support_filter(df, **x).where("kept").collect()]
    assert kept() == [1, 2, 3, 4] and kept(single_least=2) == [2, 3, 4] and kept(least=2, single_least=1) == [4]
    assert kept(least=2, rescue=20.0) == [3, 4] and kept(least=2, rescue=20.0, whole_codons=True) == [4]
    weights = spark.createDataFrame([("GlimmerHMM",), ("EST",), ("other",)], "s string").select(consensus.weight_for(F.col("s"))).collect()
    assert [r[0] for r in weights] == [2.0, 8.0, 1.0]


def test_description_and_orf(spark):
    df = spark.createDataFrame([("sp|P1|K_YEAST Protein kinase OS=S",), ("tr|X|Y_Z OS=Q",), ("plain",)], "d string")
    got = [r[0] for r in df.select(hits.clean_description(F.col("d"))).collect()]
    assert got[0] == "Protein kinase"
    orf = spark.createDataFrame([("ATGAAATAA",), ("ATGTAATAA",), ("ATGAAAA",), ("CTGAAATAA",), ("ATGAAA",)], "s string")
    assert [r[0] for r in orf.select(formats.orf_status(F.col("s"))).collect()] == ["Complete", "InternalStop", "BadLength", "NoStart", "NoStop"]


def test_student_tails_against_tables(spark):
    rows = [(12.706, 1), (4.303, 2), (3.182, 3), (2.776, 4), (2.228, 10), (2.262, 9), (1.984, 100), (0.0, 7)]
    got = [r[0] for r in spark.createDataFrame(rows, "t double, n int").select(expression.student_tail(F.col("t"), F.col("n"))).collect()]
    assert all(abs(p - 0.05) < 1e-4 for p in got[:-1]) and got[-1] == 1.0


def test_long_files_of_codes_agree():
    assert len(sequences.CODES) == 25 and sequences.codons(2)["AGA"] == "*" and sequences.codons(33)["AGG"] == "K" and sequences.codons(11) == sequences.codons(1)


def test_tables_with_wrong_headers_or_cells_are_errors(spark):
    import pytest

    good = [("s", 0, "Name\tTPM"), ("s", 1, "t1\t2.5"), ("s", 1, "t2\t0")]
    read = lambda rows, **x: formats.parse_quant(spark.createDataFrame(rows, "sample string, n int, value string"), {"Name": "id", "TPM": "tpm"}, "Name", **x).collect()
    assert sorted((r["id"], r["tpm"]) for r in read(good)) == [("t1", 2.5), ("t2", 0.0)]
    for bad, x in (([("s", 1, "t\t1")], {}), ([("s", 0, "Name\tReads"), ("s", 1, "t\t1")], {}), ([*good, ("s", 1, "t3\tmany")], {}), (good, {"header_in_place": ["Name", "Length"]})):
        with pytest.raises(Exception, match="table of sample"):
            read(bad, **x)


def test_orf_of_code_6_and_without_sequence(spark):
    df = spark.createDataFrame([("ATGTAATGA",), (None,)], "s string")
    assert [r[0] for r in df.select(formats.orf_status(F.col("s"), code=6)).collect()] == ["Complete", "Unverifiable"]


def test_intervals_of_all_lengths_and_null_keys(spark):
    rng = random.Random(3)
    make = lambda n: [(k, rng.choice(["x", "y", None]), s := rng.randint(1, 9000), s + rng.choice([0, 5, 90, 1500, 40_000, 3_000_000])) for k in range(n)]
    left, right = make(90), make(80)
    a, b = spark.createDataFrame(left, "i int, seqid string, s1 long, e1 long"), spark.createDataFrame(right, "j int, seqid string, s2 long, e2 long")
    got = sorted(tuple(r) for r in iv.overlap_join(a, b, ["seqid"], "s1", "e1", "s2", "e2", width=16).select("i", "j").collect())
    assert got == sorted((i, j) for i, c, s, e in left for j, d, t, f in right if c == d and c is not None and s <= f and t <= e)
    # a long interval is a few rows
    long = spark.createDataFrame([("x", 1, 1_000_000)], "seqid string, s long, e long")
    assert iv._binned(long, "s", "e", iv.BIN, True).count() <= 2


def test_clusters_over_tiles(spark):
    rng = random.Random(4)
    rows = [(k, rng.choice(["x", None]), s := rng.randint(1, 5000), s + rng.choice([3, 10, 30, 800])) for k in range(150)]
    df = spark.createDataFrame(rows, "i int, seqid string, s long, e long")
    for gap in (0, 1, 7):
        want = {}
        for c in ("x", None):
            reach, locus = None, 0
            for i, _, s, e in sorted((r for r in rows if r[1] == c), key=lambda r: (r[2], r[3], r[0])):
                locus += reach is None or s > reach + gap
                reach = e if reach is None else max(reach, e)
                want[i] = locus
        got = {r["i"]: r["locus"] for r in iv.cluster(df, ["seqid"], "s", "e", ["e", "i"], gap=gap, tile=64).collect()}
        assert got == want


def test_locus_tags_beyond_a_million(spark):
    genes = spark.createDataFrame([("c", k, k) for k in range(1, 4)], "seqid string, g_start long, gid long")
    assert [r["locus_tag"] for r in features.number_loci(genes, first=999_999).orderBy("gid").collect()] == ["LOC_0999999", "LOC_1000000", "LOC_1000001"]
    assert [r["locus_tag"] for r in features.number_loci(genes).orderBy("gid").collect()] == ["LOC_000001", "LOC_000002", "LOC_000003"]


def test_equal_intervals_merge_whichever_side_a_join_broadcasts(spark, monkeypatch):
    frame = type(spark.range(1))
    join = frame.join
    monkeypatch.setattr(frame, "join", lambda self, other, *how: join(self.hint("broadcast"), other, *how))
    rows = [("c", s, e) for s, e in [(1, 10), (20, 30), (50, 60)] for _ in range(4)]
    got = iv.merge(spark.createDataFrame(rows, "seqid string, s long, e long").repartition(3), ["seqid"], "s", "e").collect()
    assert sorted((r["s"], r["e"], r["n_merged"]) for r in got) == [(1, 10, 4), (20, 30, 4), (50, 60, 4)]


def test_models_pass_from_batch_to_batch(spark):
    rng = random.Random(5)
    seq = {c: "".join(rng.choice("ACGTacgtN") for _ in range(300)) for c in "ab"} | {"é": "ACGTé" * 60}
    contigs = spark.createDataFrame(list(seq.items()), "seqid string, seq string")
    segs = [(rng.choice("abé"), k if k else None, rng.choice(["+", "-", None]), s := rng.randint(-5, 290), s + rng.randint(0, 90)) for k in range(300) for _ in range(rng.randint(1, 9))]
    segs += [("a", 1000, "-", 1 + k % 290, 5 + k % 290) for k in range(5000)]  # longer than a slice of a batch
    got = formats.spliced(spark.createDataFrame(segs, "seqid string, gid int, strand string, seg_start long, seg_end long"), contigs, size=32).collect()
    want = {}
    for c, g, t, s, e in segs:
        pieces = [(s, e, k, seq[c][max(s - 1, 32 * k) : min(e, 32 * k + 32)]) for k in range((max(s, 1) - 1) // 32, (e - 1) // 32 + 1) if 32 * k < len(seq[c])]
        if pieces and e > 0:
            want.setdefault((g, t), []).extend(pieces)
    want = {k: "".join(x[3] for x in sorted(v)) for k, v in want.items()}
    want = {k: v[::-1].translate(str.maketrans("ACGTacgt", "TGCAtgca")) if k[1] == "-" else v for k, v in want.items()}
    assert len(got) == len(want) and {(r["gid"], r["strand"]): r["cds"] for r in got} == want
    plan = formats.spliced(spark.createDataFrame(segs, "seqid string, gid int, strand string, seg_start long, seg_end long"), contigs)._jdf.queryExecution().toString()
    assert "ObjectHashAggregate" not in plan and "collect_list" not in plan
