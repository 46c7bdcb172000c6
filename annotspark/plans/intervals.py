"""Queries of the interval and consensus operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from annotspark.operators import consensus, intervals as iv
from annotspark.registry import query
from annotspark.tables import written

KEYS = ["seqid", "strand"]
OVER = "a.seqid = b.seqid AND a.strand = b.strand"


@query("I01_overlap_join", "fx_gene", f"""SELECT a.gid AS gid_a, b.gid AS gid_b, CAST(least(a.g_end, b.g_end) - greatest(a.g_start, b.g_start) + 1 AS BIGINT) AS bp
FROM fx_gene a JOIN fx_gene b ON {OVER} AND a.g_start <= b.g_end AND b.g_start <= a.g_end AND a.gid < b.gid""")  # fmt: skip
def i01(genes):
    a = genes.select(*KEYS, F.col("gid").alias("gid_a"), F.col("g_start").alias("s1"), F.col("g_end").alias("e1"))
    b = genes.select(*KEYS, F.col("gid").alias("gid_b"), F.col("g_start").alias("s2"), F.col("g_end").alias("e2"))
    met = iv.overlap_join(a, b, KEYS, "s1", "e1", "s2", "e2", on=F.col("gid_a") < F.col("gid_b"))
    return met.select("gid_a", "gid_b", iv.overlap_bp("s1", "e1", "s2", "e2").cast("long").alias("bp"))


MERGED = """SELECT seqid, min(seg_start) AS seg_start, max(seg_end) AS seg_end, count(*) AS n_merged FROM (
  SELECT *, sum(new) OVER (PARTITION BY seqid ORDER BY seg_start, seg_end, gid, ord) AS run FROM (
    SELECT *, CASE WHEN seg_start <= max(seg_end) OVER (PARTITION BY seqid ORDER BY seg_start, seg_end, gid, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new
    FROM fx_cds)) GROUP BY seqid, run"""


@query("I02_merge_intervals", "fx_cds", MERGED)
def i02(segs):
    return iv.merge(written(segs.select("seqid", "seg_start", "seg_end"), "segments"), ["seqid"], "seg_start", "seg_end")


PAIR_BP = f"""SELECT a.gid AS a, b.gid AS b, CAST(sum(least(a.seg_end, b.seg_end) - greatest(a.seg_start, b.seg_start) + 1) AS BIGINT) AS bp
FROM fx_cds a JOIN fx_cds b ON {OVER} AND a.seg_start <= b.seg_end AND b.seg_start <= a.seg_end AND a.gid <> b.gid GROUP BY 1, 2"""


@query("I05_interval_overlap_bp", "fx_cds", PAIR_BP)
def i05(segs):
    return iv.pair_overlap(segs, "gid", KEYS, "seg_start", "seg_end")


JACCARD = f"""SELECT p.a, p.b, p.bp, p.bp / CAST(x.cds_len + y.cds_len - p.bp AS DOUBLE) AS jaccard FROM ({PAIR_BP}) p
JOIN fx_gene x ON x.gid = p.a JOIN fx_gene y ON y.gid = p.b"""


@query("I06_cds_jaccard", "fx_cds", f"SELECT a, b, bp, round(jaccard, 6) AS jaccard FROM ({JACCARD})")
def i06(segs):
    return iv.jaccard(segs, "gid", KEYS, "seg_start", "seg_end").withColumn("jaccard", F.round("jaccard", 6))


LOCI = """SELECT *, CAST(sum(new) OVER (PARTITION BY seqid, strand ORDER BY g_start, g_end, gid) AS BIGINT) AS locus FROM (
  SELECT *, CASE WHEN g_start <= max(g_end) OVER (PARTITION BY seqid, strand ORDER BY g_start, g_end, gid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS new FROM fx_gene)"""


@query("I07_locus_cluster", "fx_gene", f"SELECT gid, locus FROM ({LOCI})")
def i07(genes):
    return iv.cluster(written(genes, "models"), KEYS, "g_start", "g_end", ["g_end", "gid"]).select("gid", "locus")


REGIONS = "SELECT seqid, g_start - 300 AS r_start, g_end + 300 AS r_end, gid AS region FROM fx_gene WHERE gid % 10 = 0"


@query("I11_containment_assign", "fx_gene", f"""SELECT gid, max(region) AS region, count(*) AS n_regions FROM fx_gene g JOIN ({REGIONS}) r
ON g.seqid = r.seqid AND g_start >= r_start AND g_end <= r_end GROUP BY gid""")  # fmt: skip
def i11(genes):
    regions = genes.where("gid % 10 = 0").select("seqid", (F.col("g_start") - 300).alias("r_start"), (F.col("g_end") + 300).alias("r_end"), F.col("gid").alias("region"))
    met = iv.contained_in(genes, regions, ["seqid"], "g_start", "g_end", "r_start", "r_end")
    return met.groupBy("gid").agg(F.max("region").alias("region"), F.count("*").alias("n_regions"))


@query("I12_overlap_exists", "fx_gene", """SELECT gid, seqid, g_start, g_end FROM fx_gene g WHERE EXISTS (SELECT 1 FROM fx_gene h WHERE h.gid % 10 = 3 AND h.gid <> g.gid
AND h.seqid = g.seqid AND h.g_start <= g.g_end AND g.g_start <= h.g_end)""")  # fmt: skip
def i12(genes):
    marks = genes.where("gid % 10 = 3").select("seqid", F.col("gid").alias("hit"), F.col("g_start").alias("h_start"), F.col("g_end").alias("h_end"))
    met = iv.overlap_join(genes, marks, ["seqid"], "g_start", "g_end", "h_start", "h_end", on=F.col("gid") != F.col("hit"))
    return genes.join(met.select("gid"), "gid", "left_semi").select("gid", "seqid", "g_start", "g_end")


@query("I14_variant_to_cds", "fx_vcf fx_cds", """SELECT v.event_id, c.gid, CAST(c.off + CASE WHEN c.strand = '-' THEN c.seg_end - v.pos ELSE v.pos - c.seg_start END AS BIGINT) AS cds_pos
FROM fx_vcf v JOIN (SELECT *, coalesce(sum(seg_end - seg_start + 1) OVER (PARTITION BY gid ORDER BY CASE WHEN strand = '-' THEN -seg_start ELSE seg_start END
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM fx_cds) c ON v.chrom = c.seqid AND v.pos BETWEEN c.seg_start AND c.seg_end""")  # fmt: skip
def i14(variants, segs):
    placed = iv.transcript_offset(segs, "gid", "strand", "seg_start", "seg_end")
    points = variants.select("event_id", F.col("chrom").alias("seqid"), "pos", F.col("pos").alias("pos_end"))
    met = iv.overlap_join(points, placed, ["seqid"], "pos", "pos_end", "seg_start", "seg_end")
    inside = F.when(F.col("strand") == "-", F.col("seg_end") - F.col("pos")).otherwise(F.col("pos") - F.col("seg_start"))
    return met.select("event_id", "gid", (F.col("offset") + inside).cast("long").alias("cds_pos"))


PARTS = """SELECT *, CASE WHEN min(psize) OVER (PARTITION BY gid) >= 80 THEN p ELSE 0 END AS part FROM (
  SELECT *, sum(seg_end - seg_start + 1) OVER (PARTITION BY gid, p) AS psize FROM (
    SELECT *, sum(cut) OVER (PARTITION BY gid ORDER BY seg_start) AS p FROM (
      SELECT *, CASE WHEN seg_start - lag(seg_end) OVER (PARTITION BY gid ORDER BY seg_start) - 1 > 130 THEN 1 ELSE 0 END AS cut FROM fx_cds)))"""


@query("I15_split_long_gaps", "fx_cds", f"SELECT gid, ord, CAST(part AS BIGINT) AS part FROM ({PARTS})")
def i15(segs):
    return iv.split_gaps(segs, "gid", "seg_start", "seg_end", 130, 80).select("gid", "ord", F.col("part").cast("long").alias("part"))


@query("C05_jaccard_clip", "fx_cds", f"SELECT count(*) AS parts, count(DISTINCT gid) AS models, count(*) - count(DISTINCT gid) AS extra FROM (SELECT DISTINCT gid, part FROM ({PARTS}))")
def c05(segs):
    parts = iv.split_gaps(segs, "gid", "seg_start", "seg_end", 130, 80).select("gid", "part").distinct()
    n = parts.agg(F.count("*").alias("parts"), F.count_distinct("gid").alias("models"))
    return n.withColumn("extra", F.col("parts") - F.col("models"))


@query("W07_running_offset", "fx_cds", """SELECT gid, ord, CAST(coalesce(sum(seg_end - seg_start + 1) OVER (PARTITION BY gid ORDER BY CASE WHEN strand = '-' THEN -seg_start ELSE seg_start END
ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM fx_cds""")  # fmt: skip
def w07(segs):
    return iv.transcript_offset(segs, "gid", "strand", "seg_start", "seg_end").select("gid", "ord", F.col("offset").cast("long").alias("before"))


SCORED = f"""SELECT l.*, round(l.weight + coalesce(s.agree, 0), 9) AS score FROM ({LOCI}) l LEFT JOIN
(SELECT j.a AS gid, sum(y.weight * j.jaccard) AS agree FROM ({JACCARD}) j JOIN fx_gene y ON y.gid = j.b GROUP BY j.a) s ON s.gid = l.gid"""
WON = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seqid, strand, locus ORDER BY score DESC, weight DESC, cds_len DESC, g_start DESC, gid DESC) AS r
FROM ({SCORED})) WHERE r = 1"""


@query("C01_consensus_merge", "fx_gene fx_cds", f"SELECT gid, seqid, strand, source, locus, round(score, 6) AS score FROM ({WON})")
def c01(genes, segs):
    genes, segs = written(genes, "models"), written(segs, "segments")  # several steps read them
    best = consensus.winners(consensus.scored(genes, segs))
    return best.select("gid", "seqid", "strand", "source", "locus", F.round("score", 6).alias("score"))


#: Winners with their support, and whether they stay.
SUPPORTED = f"""w AS ({WON}), m AS (SELECT p.a AS gid, g.source FROM ({PAIR_BP}) p JOIN w ON w.gid = p.a JOIN fx_gene g ON g.gid = p.b
  UNION ALL SELECT gid, source FROM w),
s AS (SELECT gid, count(DISTINCT source) AS support, bool_and(source IN ('augustus', 'snap', 'genemark', 'glimmerhmm')) AS ab FROM m GROUP BY gid),
k AS (SELECT w.gid, s.support, n_seg, (s.support >= CASE WHEN n_seg = 1 AND ab THEN 2 ELSE 1 END OR score >= 12) AS kept FROM w JOIN s ON s.gid = w.gid)"""


@query("C02_consensus_support_filter", "fx_gene fx_cds", f"""WITH {SUPPORTED}
SELECT gid, support, kept, CASE WHEN kept THEN 'kept' WHEN n_seg = 1 THEN 'single_exon_ab_initio' ELSE 'low_support' END AS reason FROM k""")
def c02(genes, segs):
    genes, segs = written(genes, "models"), written(segs, "segments")  # several steps read them
    pairs = written(iv.jaccard(segs, "gid", consensus.KEYS, "seg_start", "seg_end"), "pairs")
    models = written(consensus.scored(genes, segs, pairs=pairs), "scored")
    best = consensus.support(models, consensus.winners(models), segs, pairs=pairs)
    return consensus.support_filter(best, single_least=2, rescue=12.0).select("gid", "support", "kept", "reason")


COVER = "SELECT seqid, sum(seg_end - seg_start + 1) AS n FROM ({}) GROUP BY seqid"


def _merged(view: str) -> str:
    return MERGED.replace("fx_cds", view)


BASES = f"""SELECT CAST(t.tp AS BIGINT) AS tp, CAST(p.n - t.tp AS BIGINT) AS fp, CAST(r.n - t.tp AS BIGINT) AS fn FROM
(SELECT sum(least(a.seg_end, b.seg_end) - greatest(a.seg_start, b.seg_start) + 1) AS tp FROM ({_merged("fx_cds")}) a JOIN ({_merged("fx_ref")}) b
 ON a.seqid = b.seqid AND a.seg_start <= b.seg_end AND b.seg_start <= a.seg_end) t,
(SELECT sum(seg_end - seg_start + 1) AS n FROM ({_merged("fx_cds")})) p, (SELECT sum(seg_end - seg_start + 1) AS n FROM ({_merged("fx_ref")})) r"""


def coding_bases(pred, ref):
    """tp, fp, fn of coding positions, strand ignored, each position once: merged intervals, no position is listed."""
    a = iv.merge(pred, ["seqid"], "seg_start", "seg_end").select("seqid", F.col("seg_start").alias("s1"), F.col("seg_end").alias("e1"))
    b = iv.merge(ref, ["seqid"], "seg_start", "seg_end").select("seqid", F.col("seg_start").alias("s2"), F.col("seg_end").alias("e2"))
    tp = iv.overlap_join(a, b, ["seqid"], "s1", "e1", "s2", "e2").agg(F.coalesce(F.sum(iv.overlap_bp("s1", "e1", "s2", "e2")), F.lit(0)).alias("tp"))
    n = a.agg(F.sum(F.col("e1") - F.col("s1") + 1).alias("np")).crossJoin(b.agg(F.sum(F.col("e2") - F.col("s2") + 1).alias("nr")))  # one row each
    return tp.crossJoin(n).select("tp", (F.col("np") - F.col("tp")).alias("fp"), (F.col("nr") - F.col("tp")).alias("fn"))


@query("I16_coding_base_overlap", "fx_cds fx_ref", BASES)
def i16(pred, ref):
    return coding_bases(pred, ref)


@query("E03_nucleotide_metrics", "fx_cds fx_ref", f"""SELECT round(tp / CAST(tp + fn AS DOUBLE), 4) AS sensitivity, round(tp / CAST(tp + fp AS DOUBLE), 4) AS specificity,
round(2.0 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 4) AS f1 FROM ({BASES})""")  # fmt: skip
def e03(pred, ref):
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return coding_bases(pred, ref).select(
        F.round(tp / (tp + fn), 4).alias("sensitivity"), F.round(tp / (tp + fp), 4).alias("specificity"), F.round(2 * tp / (2 * tp + fp + fn), 4).alias("f1")
    )


@query("I10_self_alignment_regions", "fx_paf", """SELECT seqid, r_start, r_end FROM (SELECT qname AS seqid, q_start AS r_start, q_end AS r_end FROM fx_paf WHERE qname <> tname AND block >= 400
UNION ALL SELECT tname, t_start, t_end FROM fx_paf WHERE qname <> tname AND block >= 400)""")  # fmt: skip
def i10(paf):
    far = paf.where("qname <> tname AND block >= 400")
    sides = F.explode(F.array(F.struct(F.col("qname").alias("seqid"), F.col("q_start").cast("long").alias("r_start"), F.col("q_end").cast("long").alias("r_end")), F.struct(F.col("tname").alias("seqid"), F.col("t_start").cast("long").alias("r_start"), F.col("t_end").cast("long").alias("r_end"))))
    return far.select(sides.alias("x")).select("x.*")


@query("I17_read_extents", "fx_paf", "SELECT qname, min(q_start) AS x_start, max(t_end) AS x_end, count(*) AS n FROM fx_paf GROUP BY qname")
def i17(paf):
    return paf.groupBy("qname").agg(F.min("q_start").alias("x_start"), F.max("t_end").alias("x_end"), F.count("*").alias("n"))
