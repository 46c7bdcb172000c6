"""Scoring of one annotation against another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.operators import intervals as iv
from annotspark.registry import query

KEYS = ["seqid", "strand"]
_REF_GENE = "SELECT gid AS rid, seqid, strand, min(seg_start) AS r_start, max(seg_end) AS r_end, string_agg(concat(seg_start, '-', seg_end), ',' ORDER BY seg_start, seg_end) AS r_key FROM fx_ref GROUP BY 1, 2, 3"
_PRED_GENE = "SELECT gid, seqid, strand, min(seg_start) AS g_start, max(seg_end) AS g_end, string_agg(concat(seg_start, '-', seg_end), ',' ORDER BY seg_start, seg_end) AS g_key, count(*) AS n_seg FROM fx_cds GROUP BY 1, 2, 3"


def models(segs: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """One row per model: span and its segments as a key."""
    parts = F.sort_array(F.collect_list(F.struct("seg_start", "seg_end")))
    key = F.array_join(F.transform(parts, lambda x: F.concat_ws("-", x["seg_start"], x["seg_end"])), ",")
    return segs.groupBy(F.col("gid").alias(id_col), *KEYS).agg(F.min("seg_start").alias(f"{prefix}_start"), F.max("seg_end").alias(f"{prefix}_end"), key.alias(f"{prefix}_key"), F.count("*").alias(f"{prefix}_n"))


def gene_matches(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(gid, loose, moderate, strict): each prediction's first matching reference by start, as (start, rid), in each mode."""
    p, r = models(pred, "gid", "g"), models(ref, "rid", "r")
    met = iv.overlap_join(p, r, KEYS, "g_start", "g_end", "r_start", "r_end")
    shorter = F.least(F.col("g_end") - F.col("g_start") + 1, F.col("r_end") - F.col("r_start") + 1)
    fits = {"loose": F.lit(True), "moderate": iv.overlap_bp("g_start", "g_end", "r_start", "r_end") * 2 >= shorter, "strict": F.col("g_key") == F.col("r_key")}
    return met.groupBy("gid").agg(*[F.min(F.when(c, F.struct("r_start", "rid"))).alias(m) for m, c in fits.items()])


_MODES = {"loose": "true", "moderate": "2 * (least(g_end, r_end) - greatest(g_start, r_start) + 1) >= least(g_end - g_start + 1, r_end - r_start + 1)", "strict": "g_key = r_key"}
_E01 = " UNION ALL ".join(
    f"""SELECT '{m}' AS mode, count(*) AS tp, (SELECT count(*) FROM p) - count(*) AS fp, (SELECT count(*) FROM r) - count(DISTINCT rid) AS fn FROM (
SELECT p.gid, r.rid, row_number() OVER (PARTITION BY p.gid ORDER BY r_start, rid) AS n FROM p JOIN r ON p.seqid = r.seqid AND p.strand = r.strand AND g_start <= r_end AND r_start <= g_end WHERE {c}) WHERE n = 1"""
    for m, c in _MODES.items()
)


@query("E01_gene_match_metrics", "fx_cds fx_ref", f"""WITH p AS ({_PRED_GENE}), r AS ({_REF_GENE}), m AS ({_E01})
SELECT mode, tp, fp, fn, round(2.0 * tp / (2 * tp + fp + fn), 4) AS f1 FROM m""")  # fmt: skip
def e01(pred, ref):
    n = pred.agg(F.count_distinct("gid").alias("np")).crossJoin(ref.agg(F.count_distinct("gid").alias("nr")))  # one row each
    met = gene_matches(pred, ref)
    # one row a reference that is found in a mode, with how many predictions find it
    modes = met.select(F.explode(F.array(*[F.struct(F.lit(m).alias("mode"), F.col(f"{m}.rid").alias("rid")) for m in _MODES])).alias("x")).select("x.*")
    found = modes.groupBy("mode", "rid").agg(F.count("*").alias("n")).groupBy("mode").agg(F.coalesce(F.sum(F.when(F.col("rid").isNotNull(), F.col("n"))), F.lit(0)).alias("tp"), F.count("rid").alias("found"))
    every = pred.sparkSession.createDataFrame([(m,) for m in _MODES], "mode string").join(found, "mode", "left").na.fill(0, ["tp", "found"])
    rows = every.crossJoin(n).select("mode", "tp", (F.col("np") - F.col("tp")).alias("fp"), (F.col("nr") - F.col("found")).alias("fn"))  # one row
    return rows.withColumn("f1", F.round(2.0 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn")), 4))


_EXON = "SELECT DISTINCT seqid, seg_start, seg_end, strand FROM {}"


def exact_sets(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """Sizes of the intersection and both differences of the segment sets, in one aggregation."""
    cols = ["seqid", "seg_start", "seg_end", "strand"]
    both = pred.select(*cols, F.lit(1).alias("p"), F.lit(0).alias("r")).unionByName(ref.select(*cols, F.lit(0).alias("p"), F.lit(1).alias("r")))
    sides = both.groupBy(*cols).agg(F.max("p").alias("p"), F.max("r").alias("r"))
    p, r = F.col("p") == 1, F.col("r") == 1
    return sides.agg(F.count_if(p & r).alias("both"), F.count_if(p & ~r).alias("pred_only"), F.count_if(r & ~p).alias("ref_only"))


_U05 = f"""SELECT (SELECT count(*) FROM ({_EXON.format("fx_cds")} INTERSECT {_EXON.format("fx_ref")})) AS both, (SELECT count(*) FROM ({_EXON.format("fx_cds")} EXCEPT {_EXON.format("fx_ref")})) AS pred_only,
(SELECT count(*) FROM ({_EXON.format("fx_ref")} EXCEPT {_EXON.format("fx_cds")})) AS ref_only"""


@query("U05_exact_set_match", "fx_cds fx_ref", _U05)
def u05(pred, ref):
    return exact_sets(pred, ref)


@query("E02_exon_metrics", "fx_cds fx_ref", f"""SELECT u.*, round(2.0 * "both" / (2 * "both" + pred_only + ref_only), 4) AS exact_f1, o.hit AS pred_overlapping FROM ({_U05}) u,
(SELECT count(*) AS hit FROM fx_cds p WHERE EXISTS (SELECT 1 FROM fx_ref r WHERE r.seqid = p.seqid AND r.strand = p.strand AND r.seg_start <= p.seg_end AND p.seg_start <= r.seg_end)) o""")  # fmt: skip
def e02(pred, ref):
    a = pred.select(*KEYS, "gid", "ord", "seg_start", "seg_end")
    b = ref.select(*KEYS, F.col("seg_start").alias("s2"), F.col("seg_end").alias("e2"))
    hit = iv.overlap_join(a, b, KEYS, "seg_start", "seg_end", "s2", "e2").select("gid", "ord").distinct().agg(F.count("*").alias("pred_overlapping"))
    n, p, r = F.col("both"), F.col("pred_only"), F.col("ref_only")
    return exact_sets(pred, ref).withColumn("exact_f1", F.round(2.0 * n / (2 * n + p + r), 4)).crossJoin(hit)  # one row each


@query("E04_annotation_profile", "fx_gene", """SELECT count(*) AS genes, CAST(sum(n_seg) AS BIGINT) AS segments, round(avg(g_end - g_start + 1), 6) AS mean_length, count(*) FILTER (WHERE n_seg = 1) AS single,
round(avg(n_seg), 6) AS segments_per_gene FROM fx_gene""")  # fmt: skip
def e04(genes):
    return genes.agg(F.count("*").alias("genes"), F.sum("n_seg").alias("segments"), F.round(F.avg(F.col("g_end") - F.col("g_start") + 1), 6).alias("mean_length"), F.count_if(F.col("n_seg") == 1).alias("single"), F.round(F.avg("n_seg"), 6).alias("segments_per_gene"))


_SAME = "p.seqid = r.seqid AND p.strand = r.strand AND p.g_key = r.r_key"


@query("E06_lost_votes", "fx_cds fx_ref", f"""WITH p AS (SELECT g.*, f.source FROM ({_PRED_GENE}) g JOIN (SELECT DISTINCT gid, source FROM fx_cds) f ON f.gid = g.gid), r AS ({_REF_GENE})
SELECT voters, count(*) AS n FROM (SELECT r.rid, coalesce(string_agg(DISTINCT p.source, '+' ORDER BY p.source), 'none') AS voters FROM r LEFT JOIN p ON {_SAME} GROUP BY r.rid) GROUP BY voters""")  # fmt: skip
def e06(pred, ref):
    p = models(pred, "gid", "g").join(pred.select("gid", "source").distinct(), "gid").select(*KEYS, F.col("g_key").alias("key"), "source")
    r = models(ref, "rid", "r").withColumnRenamed("r_key", "key")
    votes = r.join(p, [*KEYS, "key"], "left").groupBy("rid").agg(F.array_join(F.sort_array(F.collect_set("source")), "+").alias("v"))
    return votes.groupBy(F.when(F.col("v") == "", "none").otherwise(F.col("v")).alias("voters")).agg(F.count("*").alias("n"))


@query("E07_oracle_headroom", "fx_cds fx_ref", f"""WITH p AS (SELECT g.*, f.source FROM ({_PRED_GENE}) g JOIN (SELECT DISTINCT gid, source FROM fx_cds) f ON f.gid = g.gid), r AS ({_REF_GENE}),
x AS (SELECT r.rid, max(CASE WHEN p.source = 'protein' THEN 1 ELSE 0 END) AS chosen, max(CASE WHEN p.source IS NOT NULL THEN 1 ELSE 0 END) AS any_tool FROM r LEFT JOIN p ON {_SAME} GROUP BY r.rid)
SELECT count(*) AS refs, CAST(sum(chosen) AS BIGINT) AS consensus_right, CAST(sum(any_tool) AS BIGINT) AS any_right, CAST(sum(any_tool) - sum(chosen) AS BIGINT) AS recoverable FROM x""")  # fmt: skip
def e07(pred, ref):
    p = models(pred, "gid", "g").join(pred.select("gid", "source").distinct(), "gid").select(*KEYS, F.col("g_key").alias("key"), "source")
    r = models(ref, "rid", "r").withColumnRenamed("r_key", "key")
    flag = lambda c: F.max(F.when(c, 1).otherwise(0))
    x = r.join(p, [*KEYS, "key"], "left").groupBy("rid").agg(flag(F.col("source") == "protein").alias("chosen"), flag(F.col("source").isNotNull()).alias("any_tool"))
    return x.agg(F.count("*").alias("refs"), F.sum("chosen").alias("consensus_right"), F.sum("any_tool").alias("any_right"), (F.sum("any_tool") - F.sum("chosen")).alias("recoverable"))


_HIT = "SELECT gid, rid, p.n_seg AS pn, r.n_seg AS rn, g_key = r_key AS same FROM p JOIN r ON p.seqid = r.seqid AND p.strand = r.strand AND g_start <= r_end AND r_start <= g_end"


@query("E08_metrics_by_exon_class", "fx_cds fx_ref", f"""WITH p AS ({_PRED_GENE}), r AS ({_REF_GENE.replace(" AS r_key", " AS r_key, count(*) AS n_seg")}), h AS ({_HIT}),
a AS (SELECT n_seg = 1 AS s, count(*) AS preds, count(*) FILTER (WHERE gid IN (SELECT gid FROM h)) AS pl, count(*) FILTER (WHERE gid IN (SELECT gid FROM h WHERE same)) AS ps FROM p GROUP BY 1),
b AS (SELECT n_seg = 1 AS s, count(*) AS refs, count(*) FILTER (WHERE rid IN (SELECT rid FROM h)) AS rl, count(*) FILTER (WHERE rid IN (SELECT rid FROM h WHERE same)) AS rs FROM r GROUP BY 1)
SELECT CASE WHEN a.s THEN 'single' ELSE 'multi' END AS class, preds, refs, round(rl / CAST(refs AS DOUBLE), 6) AS loose_sensitivity, round(pl / CAST(preds AS DOUBLE), 6) AS loose_specificity, round(rs / CAST(refs AS DOUBLE), 6) AS strict_sensitivity,
round(ps / CAST(preds AS DOUBLE), 6) AS strict_specificity FROM a JOIN b ON a.s = b.s""")  # fmt: skip
def e08(pred, ref):
    """Each side by its own number of segments: which references are met, and which predictions meet one."""
    p, r = models(pred, "gid", "g"), models(ref, "rid", "r")
    met = iv.overlap_join(p.select("gid", *KEYS, "g_start", "g_end", "g_key"), r.select("rid", *KEYS, "r_start", "r_end", "r_key"), KEYS, "g_start", "g_end", "r_start", "r_end").select("gid", "rid", (F.col("g_key") == F.col("r_key")).alias("same"))

    def side(rows, key, n, prefix):
        found = rows.join(met.groupBy(key).agg(F.max("same").alias("same")), key, "left")
        return found.groupBy(F.when(F.col(n) == 1, "single").otherwise("multi").alias("class")).agg(F.count("*").alias(f"{prefix}s"), F.count("same").alias(f"{prefix}_loose"), F.count_if(F.coalesce("same", F.lit(False))).alias(f"{prefix}_strict"))

    both = side(p, "gid", "g_n", "pred").join(side(r, "rid", "r_n", "ref"), "class")
    share = lambda a, b, name: F.round(F.col(a) / F.col(b), 6).alias(name)
    return both.select(
        "class", "preds", "refs", share("ref_loose", "refs", "loose_sensitivity"), share("pred_loose", "preds", "loose_specificity"), share("ref_strict", "refs", "strict_sensitivity"), share("pred_strict", "preds", "strict_specificity")
    )
