"""Numbers and names along an order, for groups of any size.

A running sum over a group that may hold much of the table goes over ranges of the order: each range is summed on its
own, and one row for each range and group says what stands before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.tables import written


def running(df: DataFrame, keys: list[str], order: list[Column], value: Column, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same keys up to this one; null keys are keys like others."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.lit(0).alias("all"))
    rows = df.withColumn("_key", key).withColumn("_value", value)
    rows = rows.repartitionByRange(parts, F.col("_key"), *order).withColumn("_p", F.spark_partition_id())
    rows = written(rows, "ranged")  # later looks see the same ranges
    inside = Window.partitionBy("_key", "_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("_key").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("_key", "_p").agg(F.sum("_value").alias("_s")).select("_key", "_p", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"))
    done = rows.join(sums, ["_key", "_p"]).withColumn(out, (F.col("_before") + F.sum("_value").over(inside)).cast("long"))
    return done.select(*[F.col(f"`{c}`") for c in df.columns], out)


def ranked(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """Adds ``out``: the row's place, from 1, among those of the same keys."""
    return running(df, keys, order, F.lit(1), out)


def unique_names(df: DataFrame, name: str, order: list[Column], keys: list[str] | None = None, taken: DataFrame | None = None, mark: str = "_dup") -> DataFrame:
    """The rows with a name of their own each: the first holder keeps it, further ones get ``mark`` and the least free numbers.

    Numbers begin at 2.  A number is taken where some row, or one of ``taken`` (keys and name), already has that name; all
    names of ``taken`` count as held before.  Null names stay null.  Only rows whose name is held twice are numbered: of
    the holders of a name the r-th gets the number ``r + m``, ``m`` being how many taken numbers stand before that one.
    """
    keys = keys or []
    col = lambda c: F.col(f"`{c}`")
    own = df.where(col(name).isNotNull()).select(*keys, col(name).alias("_name"), F.lit(0).alias("_held"))
    if taken is not None:
        own = own.unionByName(taken.where(col(name).isNotNull()).select(*keys, col(name).alias("_name"), F.lit(1).alias("_held")))
    names = own.groupBy(*keys, "_name").agg(F.count("*").alias("_n"), F.max("_held").alias("_held"))
    twice = names.where("_n > 1").select(*keys, "_name", "_held")
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    if not twice.head(1):
        return df
    held = written(twice, "twice")
    rows = df.where(col(name).isNotNull()).withColumn("_name", col(name)).alias("r")
    met = rows.join(held.alias("t"), [F.col("r._name") == F.col("t._name"), *same(rows, held)], "left").select("r.*", "t._held")
    many = ranked(met.where("_held IS NOT NULL"), [*keys, "_name"], order, "_r")
    many = many.withColumn("_j", F.col("_r") + F.col("_held") - 2)  # the how many-th number it needs, from 0; less is none
    # numbers that some row has already, with how many free ones stand before each
    number = F.regexp_extract("_name", f"^(?s)(.*){mark}([1-9][0-9]{{0,17}})$", 2)
    base = F.regexp_extract("_name", f"^(?s)(.*){mark}([1-9][0-9]{{0,17}})$", 1)
    used = names.where(number != "").select(*keys, base.alias("_name"), number.cast("long").alias("_t")).where("_t >= 2")
    used = used.join(held.drop("_held"), [*keys, "_name"], "left_semi") if not keys else used.alias("u").join(held.alias("h"), [F.col("u._name") == F.col("h._name"), *same(used, held)], "left_semi")
    used = ranked(used, [*keys, "_name"], [F.asc("_t")], "_i").select(*keys, "_name", (F.col("_t") - 1 - F.col("_i")).alias("_j"), F.lit(1).alias("_used"))
    both = many.withColumn("_used", F.lit(0)).unionByName(used, allowMissingColumns=True)
    count = running(both, [*keys, "_name"], [F.asc("_j"), F.desc("_used")], F.col("_used"), "_m").where("_used = 0")
    new = F.when(F.col("_j") < 0, F.col("_name")).otherwise(F.concat("_name", F.lit(mark), (F.col("_j") + 2 + F.col("_m")).cast("string")))
    named = count.withColumn(name, new)
    rest = met.where("_held IS NULL").select(*[col(c) for c in df.columns])
    return rest.unionByName(named.select(*[col(c) for c in df.columns])).unionByName(df.where(col(name).isNull()))
