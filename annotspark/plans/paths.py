"""Readers over paths, one for each format: ``READERS[name](spark, path)`` has ``genome_id`` first.

A genome is named by a folder ``genome_id=...`` of the path, which prunes files, else by the file's name up to its first
dot.  Ids and contigs mean something inside their genome only: :func:`scoped` makes them pairs with it, so that operators
that join, group and order by ids hold genomes apart, and :func:`unscoped` takes them apart again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotspark.plans import formats, hits, more, readers, text
from annotspark.sources import genome_of, numbered_lines, reader, records
from annotspark.sources.fasta import SPLIT, TILE, fasta_tiles


def scoped(df: DataFrame, *ids: str) -> DataFrame:
    """The rows with every id as (genome_id, id), null where the id is, and without a genome column."""
    pair = lambda c: F.when(F.col(c).isNotNull(), F.struct("genome_id", F.col(c).alias("id"))).alias(c)
    return df.select(*[pair(c) if c in ids else F.col(c) for c in df.columns if c != "genome_id"])


def unscoped(df: DataFrame, *ids: str) -> DataFrame:
    """The rows with their genome first and plain ids again."""
    genome = F.coalesce(*[F.col(f"{c}.genome_id") for c in ids]).alias("genome_id")
    return df.select(genome, *[F.col(f"{c}.id").alias(c) if c in ids else F.col(c) for c in df.columns])


def read_fasta(spark: SparkSession, path: str, upper: bool = True, last_wins: bool = False, split: int = SPLIT, tile: int = TILE) -> DataFrame:
    """(genome_id, file, record, seqid, description, tile, part): sequences of any length in tiles."""
    found = fasta_tiles(spark, path, upper, last_wins, split, tile)
    return found.select(genome_of("file").alias("genome_id"), *found.columns)


def _in_file(parse):
    """For parsers of (file, file_pos, value)."""
    return lambda spark, path: parse(numbered_lines(spark, path).withColumnRenamed("n", "file_pos"))


def _glimmer(rows: DataFrame) -> DataFrame:
    at = lambda k: F.get(F.split("value", "\t"), F.lit(k))
    rows = rows.where(at(2).isin("mRNA", "CDS"))
    return more.glimmer_genes(rows.select("genome_id", "file", "file_pos", at(0).alias("seqid"), at(6).alias("strand"), at(2).alias("type"), at(3).try_cast("long").alias("s"), at(4).try_cast("long").alias("e")))


def _table(names: dict[str, str], text_column: str, in_place: list[str] | None = None):
    """For abundance tables, one a file, which is their sample."""
    return lambda spark, path: formats.parse_quant(numbered_lines(spark, path).withColumnRenamed("file", "sample"), names, text_column, in_place)


def read_orthogroups(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, og, genome, gene): ``genome_id`` is that of the table, ``genome`` the column's name."""
    rows = numbered_lines(spark, path)
    heads = rows.where("n = 0").select("file", F.split("value", "\t").alias("_h"))
    cells = rows.where("n > 0").join(heads, "file").select("genome_id", F.split("value", "\t").alias("_c"), "_h")
    wide = cells.select("genome_id", F.get("_c", F.lit(0)).alias("og"), F.posexplode("_h").alias("k", "genome"), "_c").where("k > 0")
    genes = wide.select("genome_id", "og", "genome", F.explode(F.split(F.get("_c", F.col("k")), ",")).alias("gene"))
    return genes.withColumn("gene", F.trim("gene")).where("gene NOT IN ('', '-')")


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sheets of one header, which is the first line of the first of them."""
    rows = numbered_lines(spark, path)
    head = rows.where("n = 0").orderBy("file").first()
    if head is None:
        raise ValueError(f"no sample sheet in {path}")
    return readers.parse_sheet(rows, head["value"])


def read_formats(spark: SparkSession, path: str) -> DataFrame:
    """(genome_id, file, format) of text files, by their names and first lines."""
    first = numbered_lines(spark, path).where("n < 200").groupBy("genome_id", "file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "value"))), lambda x: x["value"]), "\n").alias("_t"))
    return first.select("genome_id", "file", text.detect_format(F.col("file"), F.col("_t")).alias("format"))


def _emapper(spark: SparkSession, path: str) -> DataFrame:
    return readers.parse_emapper(numbered_lines(spark, path), ["file", "n"])


def _phased(rows: DataFrame) -> DataFrame:
    return formats.phased(formats.parse_vcf(rows, first=False), strict=False)


READERS = {
    "gff3": formats.read_gff3, "fasta": read_fasta, "fastq": reader(readers.parse_fastq, by_place=True), "qual": lambda spark, path: readers.parse_qual(records(spark, path)),
    "vcf": reader(formats.parse_vcf), "phased_vcf": reader(_phased), "paf": reader(formats.parse_paf), "repeatmasker": reader(readers.parse_repeatmasker, by_place=True),
    "gtf": reader(formats.gtf_transcripts), "snap": _in_file(more.snap_genes), "glimmer": _in_file(_glimmer), "blast6": reader(hits.parse_blast6), "domains": reader(hits.parse_domains),
    "emapper": _emapper, "interproscan": reader(more.parse_interpro), "dbcan": reader(readers.parse_dbcan), "trnascan": reader(readers.parse_trnascan), "bgc_regions": reader(more.parse_regions),
    "busco": reader(readers.parse_busco), "quant_sf": _table({"Name": "transcript", "TPM": "tpm", "NumReads": "num_reads"}, "Name", ["Name", "Length", "EffectiveLength", "TPM", "NumReads"]),
    "abundance": _table({"target_id": "transcript", "est_counts": "est_counts", "tpm": "tpm"}, "target_id"), "orthogroups": read_orthogroups, "sample_sheet": read_sample_sheet, "run_report": reader(readers.parse_runs),
    "topology": reader(more.parse_topology), "sam": reader(more.parse_sam), "names": reader(more.parse_names), "metrics": reader(more.parse_metrics), "format": read_formats,
}
