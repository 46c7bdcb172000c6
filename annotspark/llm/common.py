"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of the contracts: space and \t \n \v \f \r.
SPACES = "\\x20\\x09-\\x0D"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; only a local session, as in tests, may leave that unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        base = "/tmp/checkpoints/annotspark"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors.

    Spark deletes the finished plan's shuffle files once the driver's JVM has found that plan unreachable, which may take
    until its memory is full; it is asked to look now, as disk is what runs out first in jobs of many tables.  It is asked
    before as well, as listeners may still have held the plan of the table before this one when it was asked then.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    look = spark.sparkContext._jvm.java.lang.System.gc
    look()
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    look()
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: an expression named inside a lambda is else computed per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
