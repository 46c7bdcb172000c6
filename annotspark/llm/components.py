"""Connected components by least labels and contraction, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.llm.common import discard, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node of the edges; label is the least node reachable.

    Every round each node takes the least node around it, or that one's if it is less still, and edges are drawn between
    what their ends took; those whose ends agree are gone.  So edges shrink from round to round, and nodes that have
    settled aren't looked at again.  Rounds are written to the shared folder and end when no edge is left.  Minima are
    combined before the shuffle and hot join keys are split at run time.
    """
    least, most = F.least(a, b), F.greatest(a, b)
    left = written(edges.where(F.col(a) != F.col(b)).select(least.alias("src"), most.alias("dst")).distinct(), "edges")
    ends = lambda e: e.select(F.col("src").alias("node"), F.col("dst").alias("near")).union(e.select(F.col("dst").alias("node"), F.col("src").alias("near")))
    labels = None
    while True:
        took = ends(left).groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("near"))
        took = written(took, "took")
        further = took.select(F.col("node").alias("near"), F.col("near").alias("far"))
        took = written(took.join(further, "near").select("node", F.col("far").alias("label")), "took")
        if labels is None:
            labels = took
        else:
            moved = took.select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels = written(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        one = left.join(took.select(F.col("node").alias("src"), F.col("label").alias("x")), "src")
        both = one.join(took.select(F.col("node").alias("dst"), F.col("label").alias("y")), "dst").where("x <> y")
        left, old = written(both.select(F.least("x", "y").alias("src"), F.greatest("x", "y").alias("dst")).distinct(), "edges"), left
        discard(old)
        if left.isEmpty():
            return labels


def stars(labels: DataFrame) -> DataFrame:
    """(a, b): an edge from each node to its component's least, instead of all the edges that made it."""
    return labels.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))


#: Parts into which the rows of one key are dealt by :func:`salted_join`.
SALTS = 16


def salted_join(rows: DataFrame, one: DataFrame, key: str, deal: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``one`` (one row for each key), for keys that hold much of ``rows``.

    Rows of a key are dealt to parts by a hash of the column ``deal``; the other side has a row for each part.
    """
    parts = one.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(deal), F.lit(SALTS)).cast("int")).join(parts, [key, "_salt"], how).drop("_salt")
