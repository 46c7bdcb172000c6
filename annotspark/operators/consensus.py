"""Agreement-weighted consensus of competing gene models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annotspark.operators import intervals as iv

#: Fixed weights of evidence sources and their other names; unknown sources weigh 1.
WEIGHTS = {
    "augustus": 10.0, "snap": 3.0, "protein": 20.0, "protein2genome": 20.0, "est": 8.0, "transcript": 8.0, "glimmerhmm": 2.0, "glimmer": 2.0,
    "genemark": 5.0, "genemark-es": 5.0, "genemark-et": 5.0, "miniprot": 20.0, "protein_evidence": 20.0, "trnascan": 15.0, "trnascan-se": 15.0,
}
AB_INITIO = ["augustus", "snap", "genemark", "glimmerhmm"]
KEYS = ["seqid", "strand"]


def scored(genes: DataFrame, segs: DataFrame, keys: list[str] = KEYS, pairs: DataFrame | None = None) -> DataFrame:
    """Models with ``locus`` and ``score`` = own weight + the weights of overlapping models times their Jaccard index.

    ``pairs`` are those of :func:`intervals.jaccard`, where they are known.
    """
    loci = iv.cluster(genes, keys, "g_start", "g_end", ["g_end", "gid"])
    pairs = iv.jaccard(segs, "gid", keys, "seg_start", "seg_end") if pairs is None else pairs
    weight = genes.select(F.col("gid").alias("b"), F.col("weight").alias("wb"))
    agree = pairs.join(weight, "b").groupBy(F.col("a").alias("gid")).agg(F.sum(F.col("wb") * F.col("jaccard")).alias("agree"))
    total = F.col("weight") + F.coalesce("agree", F.lit(0.0))
    return loci.join(agree, "gid", "left").withColumn("score", F.round(total, 9)).drop("agree")


def winners(models: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """One model per locus: by score, weight, coding length, then the last in order."""
    w = Window.partitionBy(*keys, "locus").orderBy(F.desc("score"), F.desc("weight"), F.desc("cds_len"), F.desc("g_start"), F.desc("gid"))
    return models.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def support(models: DataFrame, best: DataFrame, segs: DataFrame, keys: list[str] = KEYS, pairs: DataFrame | None = None) -> DataFrame:
    """Winners with ``support``: distinct sources of models that overlap the winner's segments, its own included."""
    pairs = iv.pair_overlap(segs, "gid", keys, "seg_start", "seg_end") if pairs is None else pairs
    source = models.select(F.col("gid").alias("b"), F.col("source").alias("sb"))
    own = best.select(F.col("gid").alias("a"), F.col("source").alias("sb"))
    met = pairs.join(best.select(F.col("gid").alias("a")), "a").join(source, "b").select("a", "sb").union(own)
    ab = F.min(F.col("sb").isin(AB_INITIO)).alias("all_ab_initio")
    return best.join(met.groupBy(F.col("a").alias("gid")).agg(F.count_distinct("sb").alias("support"), ab), "gid")


def weight_for(source, own: dict[str, float] | None = None):
    """The weight of a source column, by name in any case; ``own`` names other weights."""
    table = WEIGHTS | (own or {})
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), F.lower(source)), F.lit(1.0))


def support_filter(best: DataFrame, least: int = 1, single_least: int = 1, rescue: float | None = None, whole_codons: bool = False) -> DataFrame:
    """Adds ``kept`` and ``reason``: too little support is rescued by a score from ``rescue`` on.

    Models of one exon that only ab-initio sources support need the larger of both bars.  ``whole_codons`` drops coding
    models whose length isn't a multiple of three, whatever their score.
    """
    need = F.when((F.col("n_seg") == 1) & F.col("all_ab_initio"), max(least, single_least)).otherwise(least)
    kept = F.col("support") >= need
    if rescue is not None:
        kept = kept | (F.col("score") >= rescue)
    if whole_codons:
        broken = F.col("cds_len") % 3 != 0
        reason = F.when(broken, "incomplete_orf").when(kept, "kept")
        kept = kept & ~broken
        return best.withColumn("kept", kept).withColumn("reason", reason.when(F.col("n_seg") == 1, "single_exon_ab_initio").otherwise("low_support"))
    return best.withColumn("kept", kept).withColumn("reason", F.when(kept, F.lit("kept")).when(F.col("n_seg") == 1, F.lit("single_exon_ab_initio")).otherwise(F.lit("low_support")))
