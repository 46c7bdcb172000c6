"""Interval operators: 1-based inclusive coordinates, ``keys`` (genome, contig, strand ...) first.

Range predicates go through a bin equi-join at two widths.  Short intervals meet in fine bins; where either is long they
meet in coarse ones, so that an interval makes a few rows whatever its length.  A pair survives only in the bin where the
later of the two starts, so it comes out once and needs no distinct.

What runs along a contig (merging, clustering) is done per tile of a contig; from tile to tile only the furthest end and
the number of runs are carried, one row for each tile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BIN = 2048
#: Width of coarse bins, in fine ones, and of the longest interval that is filed in fine ones.
COARSE, SHORT = 512, 16
#: Bases of a tile along which intervals are merged and clustered.
TILE = 1 << 17


def _binned(df: DataFrame, start: str, end: str, width: int, left: bool) -> DataFrame:
    """A row for each class of partners and each bin: 0 for short ones with short ones, 1 for long ones of the left side
    with all of the right, 2 for short ones of the left side with long ones."""
    bins = lambda kind, w: F.transform(F.sequence(F.floor(F.col(start) / w), F.floor(F.col(end) / w)), lambda b: F.struct(F.lit(kind).alias("kind"), b.alias("bin")))
    fine, coarse = width, width * COARSE
    short = F.col(end) - F.col(start) < SHORT * width
    if left:
        rows = F.when(short, F.concat(bins(0, fine), bins(2, coarse))).otherwise(bins(1, coarse))
    else:
        rows = F.when(short, F.concat(bins(0, fine), bins(1, coarse))).otherwise(F.concat(bins(1, coarse), bins(2, coarse)))
    # an interval that ends before it starts meets nothing
    return df.where(F.col(start) <= F.col(end)).withColumn("_bin", F.explode(rows))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], ls: str, le: str, rs: str, re: str, width: int = BIN, on: Column | None = None) -> DataFrame:
    """Pairs whose intervals share a position; columns of both sides, keys once.  Other column names must differ."""
    met = _binned(left, ls, le, width, True).join(_binned(right, rs, re, width, False), [*keys, "_bin"])
    own = F.when(F.col("_bin.kind") == 0, F.lit(width)).otherwise(F.lit(width * COARSE))
    met = met.where((F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le)) & (F.col("_bin.bin") == F.floor(F.greatest(ls, rs) / own)))
    return (met if on is None else met.where(on)).drop("_bin")


def overlap_bp(ls: str, le: str, rs: str, re: str) -> Column:
    return F.greatest(F.lit(0), F.least(le, re) - F.greatest(ls, rs) + 1)


def cluster(df: DataFrame, keys: list[str], start: str, end: str, order: list[str], out: str = "locus", gap: int = 0, tile: int = TILE) -> DataFrame:
    """Number the runs of intervals in which each starts no later than the furthest end so far (plus ``gap``).

    Intervals are looked at in the tile of their start; what earlier tiles of the contig reach, and how many runs begin
    in them, comes from one row for each tile.
    """
    # one struct is the key of a tile: null contigs and strands are keys like others
    rows = df.withColumn("_at", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.floor(F.col(start) / tile).alias("tile")))
    along = Window.partitionBy(*[f"_at.k{i}" for i in range(len(keys))]).orderBy("_at.tile").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_at").orderBy(start, *order)
    ends = rows.groupBy("_at").agg(F.max(end).alias("_far")).withColumn("_far", F.max("_far").over(along))
    reach = F.greatest(F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.col("_far"))
    flagged = rows.join(ends, "_at").withColumn("_reach", reach)
    flagged = flagged.withColumn("_new", F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach") + gap), 1).otherwise(0)).drop("_far", "_reach")
    runs = flagged.groupBy("_at").agg(F.sum("_new").alias("_runs")).withColumn("_runs", F.coalesce(F.sum("_runs").over(along), F.lit(0)))
    # rows that the order leaves equal may come back from the join in another order: the one that begins a run goes first
    counted = Window.partitionBy("_at").orderBy(start, *order, F.desc("_new")).rowsBetween(Window.unboundedPreceding, 0)
    number = F.col("_runs") + F.sum("_new").over(counted)
    return flagged.join(runs, "_at").withColumn(out, number.cast("long")).select(*[F.col(f"`{c}`") for c in df.columns], out)


def merge(df: DataFrame, keys: list[str], start: str, end: str, gap: int = 0) -> DataFrame:
    """Merged intervals; ``gap`` 0 joins what shares a position, 1 what touches too."""
    runs = cluster(df.select(*keys, start, end), keys, start, end, [end], "_run", gap)
    return runs.groupBy(*keys, "_run").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_merged")).drop("_run")


def pair_overlap(segs: DataFrame, id_col: str, keys: list[str], start: str, end: str) -> DataFrame:
    """(a, b, bp) for ordered pairs of different models whose segments overlap."""
    a = segs.select(*keys, F.col(id_col).alias("a"), F.col(start).alias("s1"), F.col(end).alias("e1"))
    b = segs.select(*keys, F.col(id_col).alias("b"), F.col(start).alias("s2"), F.col(end).alias("e2"))
    met = overlap_join(a, b, keys, "s1", "e1", "s2", "e2", on=F.col("a") != F.col("b"))
    return met.groupBy("a", "b").agg(F.sum(overlap_bp("s1", "e1", "s2", "e2")).alias("bp"))


def jaccard(segs: DataFrame, id_col: str, keys: list[str], start: str, end: str) -> DataFrame:
    """(a, b, bp, jaccard) of the segment bases of overlapping models."""
    size = segs.groupBy(id_col).agg(F.sum(F.col(end) - F.col(start) + 1).alias("n"))
    pairs = pair_overlap(segs, id_col, keys, start, end)
    named = pairs.join(size.select(F.col(id_col).alias("a"), F.col("n").alias("na")), "a").join(size.select(F.col(id_col).alias("b"), F.col("n").alias("nb")), "b")
    return named.select("a", "b", "bp", (F.col("bp") / (F.col("na") + F.col("nb") - F.col("bp"))).alias("jaccard"))


def split_gaps(segs: DataFrame, id_col: str, start: str, end: str, max_gap: int, min_part: int) -> DataFrame:
    """Adds ``part`` (from 0): a new one behind every gap over ``max_gap``, unless some part would have under ``min_part`` bases."""
    w = Window.partitionBy(id_col).orderBy(start)
    cut = segs.withColumn("_cut", F.when(F.col(start) - F.lag(end).over(w) - 1 > max_gap, 1).otherwise(0))
    parts = cut.withColumn("_part", F.sum("_cut").over(w).cast("long"))
    size = F.sum(F.col(end) - F.col(start) + 1).over(Window.partitionBy(id_col, "_part"))
    least = parts.withColumn("_size", size).withColumn("_least", F.min("_size").over(Window.partitionBy(id_col)))
    return least.withColumn("part", F.when(F.col("_least") >= min_part, F.col("_part")).otherwise(F.lit(0))).drop("_cut", "_part", "_size", "_least")


def transcript_offset(segs: DataFrame, id_col: str, strand: str, start: str, end: str) -> DataFrame:
    """Adds ``offset``: bases of the transcript before each segment, in transcript order."""
    order = F.when(F.col(strand) == "-", -F.col(start)).otherwise(F.col(start))
    w = Window.partitionBy(id_col).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return segs.withColumn("offset", F.coalesce(F.sum(F.col(end) - F.col(start) + 1).over(w), F.lit(0)))


def contained_in(items: DataFrame, regions: DataFrame, keys: list[str], s: str, e: str, rs: str, re: str) -> DataFrame:
    """Pairs in which the item lies inside the region."""
    return overlap_join(items, regions, keys, s, e, rs, re, on=(F.col(s) >= F.col(rs)) & (F.col(e) <= F.col(re)))
