"""Steps from evidence to a gene set, and what goes out, against plain Python and literal cases."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from annotspark.operators import graph
from annotspark.plans import evidence, outputs, paths, readers, statistics
from annotspark.sources import numbered_lines

FEATURES = "parent string, type string, f_start long, f_end long, strand string"


def test_stop_codons_fold_on_both_strands_and_once(spark):
    rows = [
        ("p", "CDS", 100, 200, "+"), ("p", "CDS", 300, 397, "+"), ("p", "exon", 300, 397, "+"), ("p", "exon", 100, 250, "+"), ("p", "stop_codon", 398, 400, "+"),
        ("m", "CDS", 103, 200, "-"), ("m", "CDS", 300, 400, "-"), ("m", "exon", 103, 200, "-"), ("m", "stop_codon", 100, 102, "-"), ("m", "stop_codon", 50, 52, "-"),
        ("off", "CDS", 100, 200, "+"), ("off", "stop_codon", 202, 204, "+"), ("dot", "CDS", 10, 20, "."), ("dot", "stop_codon", 7, 9, "-"), ("none", "exon", 1, 9, "+"),
    ]
    once = evidence.fold_stop_codons(spark.createDataFrame(rows, FEATURES))
    got = {tuple(r) for r in once.collect()}
    assert {("p", "CDS", 300, 400, "+"), ("p", "exon", 300, 400, "+"), ("p", "CDS", 100, 200, "+"), ("p", "exon", 100, 250, "+")} <= got
    assert {("m", "CDS", 100, 200, "-"), ("m", "exon", 100, 200, "-"), ("m", "CDS", 300, 400, "-"), ("off", "CDS", 100, 200, "+"), ("dot", "CDS", 7, 20, "."), ("none", "exon", 1, 9, "+")} <= got
    assert {tuple(r) for r in evidence.fold_stop_codons(once).collect()} == got


def test_repeat_bar_slides(spark):
    bars = spark.createDataFrame([(x,) for x in (0.0, 0.1, 0.25, 0.4, 0.9)], "x double").select(evidence.adaptive_threshold(F.col("x"))).collect()
    assert [round(r[0], 6) for r in bars] == [0.9, 0.9, 0.7, 0.5, 0.5]


def test_masked_runs_and_masks_over_tiles(spark):
    rng = random.Random(1)
    seqs = {f"c{k}": "".join(rng.choice("ACGT" if rng.random() < 0.5 else "acgt") * rng.randint(1, 9) for _ in range(40)) for k in range(4)}
    contigs = spark.createDataFrame(list(seqs.items()), "seqid string, seq string")
    want = set()
    for name, seq in seqs.items():
        k = 0
        while k < len(seq):
            if seq[k].islower():
                j = k
                while j < len(seq) and seq[j].islower():
                    j += 1
                want.add((name, k + 1, j))
                k = j
            k += 1
    assert {tuple(r) for r in evidence.lower_runs(contigs, 16).collect()} == want
    regions = [(rng.choice(list(seqs)), s := rng.randint(0, 200), s + rng.randint(0, 40)) for _ in range(25)]
    for hard in (False, True):
        done = evidence.apply_mask(contigs, spark.createDataFrame(regions, "seqid string, m_start long, m_end long"), hard, 16)
        got = {}
        for r in done.orderBy("seqid", "tile").collect():
            got.setdefault(r["seqid"], []).append((r["part"], r["masked"]))
        for name, seq in seqs.items():
            letters = list(seq)
            hit = {p for c, s, e in regions if c == name for p in range(s, min(e, len(seq)))}
            for p in hit:
                letters[p] = "N" if hard else letters[p].lower()
            assert "".join(p for p, _ in got[name]) == "".join(letters) and sum(n for _, n in got[name]) == len(hit)


def test_tandem_repeats_against_plain_windows(spark):
    rng = random.Random(2)
    noise = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    seqs = {"a": noise(100) + "ACGGT" * 30 + noise(90), "b": noise(63), "c": "AT" * 40, "d": noise(40) + noise(37) * 4, "e": noise(300)}
    want = set()
    for name, s in seqs.items():
        marked = [False] * len(s)
        for at in range(0, len(s) - 63, 16):
            w = s[at : at + 64]
            if any(sum(x == y for x, y in zip(w, w[p:])) >= 0.75 * (64 - p) for p in range(2, 51)):
                marked[at : at + 64] = [True] * 64
        k = 0
        while k < len(s):
            j = k
            while j < len(s) and marked[j]:
                j += 1
            if j - k >= 70:
                want.add((name, k, j))
            k = max(j, k + 1)
    got = evidence.tandem_repeats(spark.createDataFrame(list(seqs.items()), "seqid string, seq string"), 70)
    assert want and {tuple(r) for r in got.collect()} == want


def test_children_of_models(spark):
    segs = spark.createDataFrame([(1, "c", "-", 10, 20), (1, "c", "-", 30, 31), (2, "c", "+", 50, 90)], "gid long, seqid string, strand string, seg_start long, seg_end long")
    named = spark.createDataFrame([(1, "L1"), (2, "L2")], "gid long, locus_tag string")
    got = sorted((r["gid"], r["type"], r["f_start"], r["f_end"]) for r in evidence.children(named, segs).collect())
    assert got == sorted([
        (1, "gene", 10, 31), (1, "mRNA", 10, 31), (1, "CDS", 10, 20), (1, "exon", 10, 20), (1, "CDS", 30, 31), (1, "exon", 30, 31), (1, "stop_codon", 10, 12),
        (2, "gene", 50, 90), (2, "mRNA", 50, 90), (2, "CDS", 50, 90), (2, "exon", 50, 90), (2, "start_codon", 50, 52), (2, "stop_codon", 88, 90),
    ])


def test_utr_extension_looks_at_first_bounds(spark):
    genes = spark.createDataFrame([("c", 1, "+", 1000, 2000), ("c", 2, "-", 5000, 6000), ("d", 3, "+", 10, 20)], "seqid string, gid int, strand string, g_start long, g_end long")
    reads = spark.createDataFrame([("c", 900, 1500), ("c", 100, 1500), ("c", 1900, 2050), ("c", 5500, 6100), ("c", 6050, 6200)], "seqid string, x_start long, x_end long")
    got = {r["gid"]: (r["u_start"], r["u_end"], r["utr5"], r["utr3"]) for r in evidence.extend_utr(genes, reads, 200).collect()}
    assert got == {1: (900, 2050, True, True), 2: (5000, 6100, True, False), 3: (10, 20, False, False)}


def test_consensus_puts_variants_in_from_behind(spark):
    contigs = spark.createDataFrame([("c", "ACGTACGTAC"), ("d", "AAAA")], "seqid string, seq string")
    rows = [("c", 2, "C", "G", 1), ("c", 5, "ACG", "T", 2), ("c", 9, "A", "ATT", 3), ("c", 10, "CC", "G", 4), ("c", 4, "T", ".", 5), ("c", 2, "C", "ctt", 6)]
    got = {r["seqid"]: r["seq"] for r in outputs.variant_consensus(contigs, spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string, line int")).collect()}
    text = list("ACGTACGTAC")
    for pos, n, alt in ((9, 1, "ATT"), (5, 3, "T"), (2, 1, "CTT"), (2, 1, "G")):
        text[pos - 1 : pos - 1 + n] = list(alt)
    # the variant at 10 ends behind the contig as it is when its turn comes
    assert got == {"c": "".join(text), "d": "AAAA"}


def test_personal_sequences(spark):
    contig = "AACCGGTTAACCGGTTAACCGGTT"
    segs = spark.createDataFrame([(1, "c", "+", 3, 8), (1, "c", "+", 11, 16), (2, "c", "-", 3, 10)], "gid long, seqid string, strand string, seg_start long, seg_end long")
    contigs = spark.createDataFrame([("c", contig)], "seqid string, seq string")
    rows = [(1, "c", 4, "C", "T", "C"), (2, "c", 8, "TAAC", "T", "TAAC"), (3, "c", 12, "C", "C", "CAA"), (4, "c", 12, "CG", "CG", "A"), (5, "c", 5, "T", "A", "T"), (6, "c", 20, "C", "A", "A")]
    haps, judged = outputs.personal_sequences(segs, contigs, spark.createDataFrame(rows, "event_id long, chrom string, pos long, ref string, hap0 string, hap1 string"))
    got = {(r["gid"], r["hap"], r["event_id"]): r["reason"] for r in judged.collect()}
    assert got == {
        (1, "hap0", 1): "applied", (1, "hap0", 2): "ref_mismatch", (1, "hap1", 3): "in_cis_overlap", (1, "hap1", 4): "in_cis_overlap", (1, "hap0", 5): "ref_mismatch",
        (2, "hap0", 1): "applied", (2, "hap0", 2): "spans_exon_boundary", (2, "hap0", 5): "ref_mismatch",
    }
    turn = lambda s: s[::-1].translate(str.maketrans("ACGT", "TGCA"))
    cds = {(r["gid"], r["hap"]): r["cds"] for r in haps.collect()}
    assert cds == {(1, "hap0"): "CTGGTT" + contig[10:16], (1, "hap1"): contig[2:8] + contig[10:16], (2, "hap0"): turn("CTGGTTAA"), (2, "hap1"): turn(contig[2:10])}


def test_components_of_chains(spark):
    edges = [(k, k + 1) for k in range(0, 40) if k % 11] + [(100, 200), (200, 150), (7, 7)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    want = {}
    for k in range(1, 41):
        want[k] = want[k - 1] if k > 1 and (k - 1) % 11 else k
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k in linked} | {100: 100, 150: 100, 200: 100}


def test_error_taxonomy(spark):
    cols = "gid long, seqid string, strand string, seg_start long, seg_end long"
    pred = [(1, "c", "+", 1, 10), (2, "c", "+", 21, 30), (3, "c", "+", 41, 80), (4, "c", "+", 101, 110), (5, "c", "+", 121, 130), (6, "c", "+", 501, 510), (7, "d", "+", 1, 30), (8, "d", "+", 25, 60)]
    ref = [(1, "c", "+", 1, 10), (2, "c", "+", 21, 33), (3, "c", "+", 41, 50), (4, "c", "+", 61, 70), (5, "c", "+", 101, 130), (6, "c", "-", 501, 510), (7, "d", "+", 28, 29), (8, "d", "+", 5, 10), (9, "d", "+", 50, 55)]
    got = {r["category"]: (r["n"], r["n_pred"], r["n_ref"]) for r in outputs.error_taxonomy(spark.createDataFrame(pred, cols), spark.createDataFrame(ref, cols)).collect()}
    assert got == {"exact": (1, 1, 1), "wrong_boundaries": (1, 1, 1), "merged": (1, 1, 2), "split": (1, 2, 1), "tangled": (1, 2, 3), "extra": (1, 1, 0), "missed": (1, 0, 1)}


def test_error_taxonomy_reads_its_inputs_once(spark):
    cols = "gid long, seqid string, strand string, seg_start long, seg_end long"
    pred, ref = spark.createDataFrame([(1, "c", "+", 1, 9)], cols), spark.createDataFrame([(2, "c", "+", 1, 9)], cols)
    assert "ExistingRDD" not in outputs.error_taxonomy(pred, ref)._jdf.queryExecution().executedPlan().toString()



def test_exact_tests_against_sums(spark):
    rows = [(3, 10, 0.5), (0, 20, 0.3), (17, 20, 0.4), (10, 10, 1.0), (9, 10, 1.0), (250, 400, 0.55)]
    got = [r[0] for r in spark.createDataFrame(rows, "h long, n long, p double").select(statistics.binomial_test(F.col("h"), F.col("n"), F.col("p"))).collect()]
    for (h, n, p), x in zip(rows, got):
        d = [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1)]
        assert abs(x - min(1.0, sum(v for v in d if v <= d[h] * (1 + 1e-7)))) < 1e-9
    rows = [(3, 5, 6, 20), (0, 5, 6, 20), (5, 5, 6, 20), (4, 10, 15, 20), (6, 10, 15, 20)]
    got = [r[0] for r in spark.createDataFrame(rows, "b long, r long, c long, n long").select(statistics.upper_tail(*[F.col(c) for c in "brcn"])).collect()]
    for (b, r, c, n), x in zip(rows, got):
        assert abs(x - sum(math.comb(c, k) * math.comb(n - c, r - k) for k in range(b, min(r, c) + 1) if r - k <= n - c) / math.comb(n, r)) < 1e-9


def test_contrast_finds_what_changed(spark):
    rows = [(f"t{t}", f"s{s}", "control" if s < 3 else "treated", float(100 * (s % 3 + 10) * (8 if t == 0 and s >= 3 else 1) + t)) for t in range(30) for s in range(6)]
    found = statistics.contrast(spark.createDataFrame(rows, "transcript string, sample string, condition string, num_reads double"))
    assert [r["transcript"] for r in found.where("significant").collect()] == ["t0"]


def test_files_are_read_by_place(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@r1 x\nACGT\n+\nIIII\n@r2\nAC\n+\nI\n")
    (tmp_path / "b.fq").write_text("".join(f"@q{k}\nAC\n+\nIJ\n" for k in range(3000)))
    rows = {r["id"]: (r["seq"], r["quality"], r["_error"] is None) for r in paths.READERS["fastq"](spark, str(tmp_path)).collect()}
    assert rows["r1"] == ("ACGT", [40] * 4, True) and not rows["r2"][2] and rows["q2999"] == ("AC", [40, 41], True) and len(rows) == 3002
    lines = numbered_lines(spark, str(tmp_path / "b.fq")).orderBy("n").collect()
    assert [r["n"] for r in lines] == list(range(12000)) and lines[4]["value"] == "@q1"
    (tmp_path / "rm").mkdir()
    (tmp_path / "rm" / "x.out").write_text("h\nh\n\n 1 2 3 4 c1 11 20 (0) C x y\n 1 2 3 4 c2 5 6 (0) C x y\n")
    assert [(r["seqid"], r["start"], r["end"]) for r in paths.READERS["repeatmasker"](spark, str(tmp_path / "rm")).where("end - start > 5").collect()] == [("c1", 10, 20)]


def test_sheet_and_reports_say_what_is_wrong(spark):
    import pytest

    lines = [(0, "sample_id\tgroup"), (1, "# note"), (2, "a\tx"), (3, "b c\tx"), (4, "a\ty"), (5, "d\tx\tz")]
    rows = {r["n"]: r["_error"] for r in readers.parse_sheet(spark.createDataFrame(lines, "n long, value string"), lines[0][1]).collect()}
    assert rows == {2: "line 3: sample_id twice", 3: "line 4: bad character in sample_id", 4: "line 5: sample_id twice", 5: "line 6: more cells than columns"}
    with pytest.raises(ValueError):
        readers.check_sheet(spark.createDataFrame([], "n long, cells array<string>"), ["sample_id", "sample_id"])
    with pytest.raises(Exception, match="unequal"):
        readers.parse_runs(spark.createDataFrame([("R\ta;b\tc",)], "value string")).collect()


def test_manifest_digests(spark):
    path = "/root/testdata/sf0.001"
    rows = {r["file"]: r for r in outputs.file_manifest(spark, path, ["region", "nation"]).collect()}
    raw = open(f"{path}/nation.parquet", "rb").read()
    assert rows["nation.parquet"]["sha256"] == hashlib.sha256(raw).hexdigest() and rows["nation.parquet"]["rows"] == 25 and rows["region.parquet"]["bytes"] > 0


def test_binomial_tails_of_many_reads(spark):
    """Against sums over all outcomes, and in ten million reads against the normal tail that they come close to."""
    rng = random.Random(3)
    rows = [(rng.randint(0, n), n, rng.choice([0.5, 0.3, 0.07, 0.4999])) for n in (1, 2, 3, 10, 17, 100, 333, 1000) for _ in range(3)] + [(0, 0, 0.5), (15, 30, 0.5), (5_003_000, 10_000_000, 0.5), (4_996_000, 10_000_000, 0.5)]
    got = [r[0] for r in spark.createDataFrame(rows, "h long, n long, p double").select(statistics.binomial_test(F.col("h"), F.col("n"), F.col("p"))).collect()]
    for (h, n, p), x in zip(rows[:-2], got):
        d = [math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)) for k in range(n + 1)]
        assert abs(x - min(1.0, math.fsum(v for v in d if v <= d[h] * (1 + 1e-7)))) < 1e-9
    for (h, n, p), x in zip(rows[-2:], got[-2:]):
        z = (abs(h - n * p) - 0.5) / math.sqrt(n * p * (1 - p))
        assert abs(x / math.erfc(z / math.sqrt(2)) - 1) < 1e-5


def test_masks_and_their_share_of_any_letters(spark):
    seqs = {"a": "ACGTnacgt" * 50, "b": "éACGTé" * 70, "c": "", "d": "acgtn" * 4000}
    want = {k: "".join(s[i : i + 97].lower() if i // 97 % 3 == 1 else s[i : i + 97].upper() for i in range(0, len(s), 97)) for k, s in seqs.items()}
    masked = evidence._masked(spark.createDataFrame(list(seqs.items()), "seqid string, seq string"))
    assert {r["seqid"]: r["seq"] for r in masked.collect()} == want
    low = [sum("a" <= c <= "z" for s in want.values() for c in s), sum(c.isascii() and c.isalpha() for s in want.values() for c in s)]
    assert abs(evidence.masked_fraction(masked).first()[0] - low[0] / low[1]) < 1e-12
    runs = {(m[0], m[1]) for m in ((r["r_start"], r["r_end"]) for r in evidence.lower_runs(masked.where("seqid = 'b'"), 100).collect())}
    import re

    assert runs == {(m.start() + 1, m.end()) for m in re.finditer("[acgtn]+", want["b"])}
    assert not evidence.lower_runs(masked, 100)._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")


def test_tandem_windows_are_found_once(spark, monkeypatch):
    calls, real = [], evidence.written
    monkeypatch.setattr(evidence, "written", lambda df, name: calls.append(name) or real(df, name))
    seqs = spark.createDataFrame([("a", "ACGTTGCAAC" * 30), ("b", None)], "seqid string, seq string")
    found = evidence.tandem_repeats(seqs, 80)
    assert calls == ["windows"] and "MapInArrow" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.collect()] == [("a", 0, 288)]


def test_repeat_fraction_makes_no_pairs(spark):
    rng = random.Random(8)
    seqs = {k: "".join(rng.choice("acgtACGTé") if rng.random() < 0.3 else rng.choice(["acgtn", "ACGTN"][n // 9 % 2]) for n in range(n_all)) for k, n_all in (("a", 200), ("b", 64), ("c", 33))}
    contigs = spark.createDataFrame([*seqs.items(), ("e", None)], "seqid string, seq string")
    segs = [(g, rng.choice("abcdef"), s := rng.randint(1, 210), s + rng.randint(0, 90)) for g in range(12) for _ in range(4)]
    want = {}
    for g, c, s, e in segs:
        n, m = want.get(g, (0, 0))
        want[g] = n + e - s + 1, m + sum(x in "acgtn" for x in seqs.get(c, "")[s - 1 : e])
    found = evidence.repeat_fraction(spark.createDataFrame(segs, "gid long, seqid string, seg_start long, seg_end long"), contigs, 16)
    got = {r["gid"]: r["fraction"] for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(got[g] - m / n) < 1e-12 for g, (n, m) in want.items())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_edits_are_hashed_and_contigs_not_sorted(spark):
    contigs = spark.createDataFrame([("a", "ACGTACGT"), ("b", "GGGG")], "seqid string, seq string")
    found = outputs.variant_consensus(contigs, spark.createDataFrame([("a", 2, "C", "TT", 1)], "chrom string, pos long, ref string, alt string, line int"))
    assert {tuple(r) for r in found.collect()} == {("a", "ATTGTACGT"), ("b", "GGGG")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_cuts_are_hashed_and_tiles_not_sorted(spark):
    contigs = spark.createDataFrame([("a", "ACGT" * 9), ("b", "GGGG")], "seqid string, seq string")
    found = evidence.apply_mask(contigs, spark.createDataFrame([("a", 14, 18)], "seqid string, m_start long, m_end long"), True, 16)
    assert {tuple(r) for r in found.collect()} == {("a", 0, "ACGTACGTACGTACNN", 2), ("a", 1, "NNGTACGTACGTACGT", 2), ("a", 2, "ACGT", 0), ("b", 0, "GGGG", 0)}
    assert "ShuffledHashJoin" in found._jdf.queryExecution().executedPlan().toString()
