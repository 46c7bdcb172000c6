"""Writing lines as files of a genome: header lines first, then rows in order, committed by renaming as Spark's writers do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.sources import carried

#: Fixed first lines of formats.
HEADERS = {"gff3": ["##gff-version 3"], "vcf": ["##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tSAMPLE"]}


def write_lines(rows: DataFrame, path: str, order: list[Column], header: list[str] | None = None, files: str = "one", compression: str = "none") -> None:
    """Write ``value`` of rows (genome_id, value, ...) below ``path`` in folders ``genome_id=...``, in ``order``.

    With ``files="one"`` a genome is one file, that one task writes.  With ``"ranges"`` the order is cut into as many ranges
    as there are shuffle partitions, whatever the genomes' sizes; a genome's files follow one another by name, and the
    first has the header.  A genome without rows has no file.  What is there already is an error.
    """
    if carried(rows) != ["genome_id"]:
        raise ValueError("rows need a genome_id")
    keys = [c.alias(f"_o{k}") for k, c in enumerate(order)]
    body = rows.select("genome_id", F.lit(1).alias("_k"), F.lit(0).alias("_n"), *[F.col(f"`{c}`") for c in rows.columns if c != "genome_id"])
    body = body.select("genome_id", "_k", "_n", F.struct(F.lit(0).alias("z"), *keys).alias("_o"), "value")
    if header:
        top = rows.select("genome_id").distinct().select("genome_id", F.lit(0).alias("_k"), F.posexplode(F.array(*map(F.lit, header))).alias("_n", "value"))
        body = top.withColumn("_o", F.lit(None).cast(body.schema["_o"].dataType)).select(*body.columns).unionByName(body)
    sort = ["genome_id", "_k", "_n", "_o"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = body.repartition("genome_id") if files == "one" else body.repartitionByRange(parts, *sort)
    dealt.sortWithinPartitions(*sort).select("genome_id", "value").write.partitionBy("genome_id").mode("error").option("compression", compression).text(path)
