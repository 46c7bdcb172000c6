"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.tables import written


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the least node that each node of an edge is joined with, itself included.

    A round takes the least component around each node, then that one's own component, and is written; rounds end
    when none changes anything.
    """
    ends = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    pairs = written(ends.union(ends.select("y", "x")).distinct(), "pairs")
    now = written(pairs.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("c")).select("node", F.least("node", "c").alias("c")), "components")
    while True:
        near = pairs.join(now.withColumnRenamed("node", "y"), "y").groupBy(F.col("x").alias("node")).agg(F.min("c").alias("near"))
        step = now.join(near, "node").select("node", "c", F.least("c", "near").alias("to"))
        far = now.select(F.col("node").alias("to"), F.col("c").alias("further"))
        after = written(step.join(far, "to", "left").select("node", "c", F.least("to", F.coalesce("further", "to")).alias("new")), "components")
        if after.where("new <> c").isEmpty():
            return after.select("node", F.col("new").alias("component"))
        now = after.select("node", F.col("new").alias("c"))
