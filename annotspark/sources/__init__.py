"""Readers of files as lines, and what turns a parser of lines into a reader of paths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: Columns that parsers pass on from their lines, before all others.
CARRIED = ("genome_id",)


def carried(rows: DataFrame) -> list[str]:
    """The genome's column where the rows have it; parsers begin their output, groups and windows with it."""
    return [c for c in CARRIED if c in rows.columns]


def genome_of(file: str = "file") -> Column:
    """The genome that a path names: its folder ``genome_id=...``, else the file's name up to the first dot."""
    folder = F.regexp_extract(file, "/genome_id=([^/]+)/", 1)
    return F.when(folder != "", F.url_decode(folder)).otherwise(F.url_decode(F.regexp_extract(file, "([^/.]+)[^/]*$", 1)))


def _read(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    read = spark.read.option("recursiveFileLookup", "false")
    text = (read.option("lineSep", separator) if separator else read).text(path)
    # a partition column prunes files by its value; elsewhere the name says the genome
    own = F.col("genome_id").cast("string") if "genome_id" in text.columns else genome_of("_metadata.file_path")
    return text.select(own.alias("genome_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_b"), "value")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, file, value): the lines of all files below ``path``, compressed ones too.

    Files in folders ``genome_id=...`` are a partitioned table: a filter on the genome reads its files only.
    """
    return _read(spark, path).drop("_b")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, file, value): what stands between marks ``>`` at the beginning of lines."""
    return _read(spark, path, "\n>").drop("_b")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, file, n, value) with lines numbered from 0 in each file, for formats in which a line's place counts.

    A file's blocks are put in order by where they begin; one task numbers one file.
    """
    read = _read(spark, path).withColumn("_i", F.monotonically_increasing_id())
    w = Window.partitionBy("file").orderBy("_b", "_i")
    return read.select("genome_id", "file", (F.row_number().over(w) - 1).cast("long").alias("n"), "value")


def reader(parse: Callable[[DataFrame], DataFrame], by_place: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    """``read(spark, path)`` for a parser of lines; ``genome_id`` is the result's first column."""

    def read(spark: SparkSession, path: str) -> DataFrame:
        return parse(numbered_lines(spark, path) if by_place else lines(spark, path))

    return read
