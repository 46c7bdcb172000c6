"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet below ``spark.checkpoint.dir``, read back: fixed rows, whatever is computed again later.

    Only a local session may leave the setting out.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "/tmp/checkpoints/annotspark"
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that one task takes of what :func:`dealt` deals.
ROWS = 400_000


def dealt(df: DataFrame, key: str, rows: int, each: int | None = None) -> DataFrame:
    """``df`` hashed by a key to as many partitions as ``rows`` fills, ``each`` to one, and no fewer than shuffles have."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, -(-rows // (each or ROWS))), key)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: an expression named inside a lambda is else computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
