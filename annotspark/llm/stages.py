"""Stages of the corpus pipeline: documents in, documents of the same columns out (the last gives packed pieces).

Null texts stay null; rows keep their other columns, and ``n_chars`` follows a text that was changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annotspark.llm import ngram_join, packing, quality_rules, secret_scan, suffix_dedup
from annotspark.llm.tokens import tokenizer_path

_LAST = (1 << 63) - 1


def _back(found: DataFrame, columns: list[str], row: str, text: Column) -> DataFrame:
    """The document columns again, from :func:`_packed`'s struct and the new text."""
    text = F.when(F.col(f"{row}.empty"), F.lit(None)).otherwise(text)
    new = found.select(F.col(row).alias("row"), text.alias("new"))
    out = []
    for c in columns:
        own = F.col("row.doc").getField(c)
        if c == "text":
            out.append(F.col("new").alias(c))
        elif c == "n_chars":
            size = F.length("new").cast(new.schema["row"].dataType["doc"].dataType["n_chars"].dataType)
            out.append(F.when(F.col("row.mark") == F.xxhash64("new"), own).otherwise(size).alias(c))
        else:
            out.append(own.alias(c))
    return new.select(*out)


def _packed(docs: DataFrame) -> DataFrame:
    """(row, text): all other columns in a struct inside ``row``, so that none can clash with an operator's."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(F.struct(F.struct(*others).alias("doc"), F.col("text").isNull().alias("empty"), F.xxhash64("text").alias("mark")).alias("row"), "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the newest policy passes."""
    return quality_rules.select_documents(docs, "v2")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id; rows without words all stay."""
    key = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("h"))
    keyed = docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    groups = ngram_join.link_components(keyed.select("key", F.col("doc.text").alias("text")), "key")
    stay = groups.where(F.col("key") == F.col("component_id")).select("key", (F.col("n_shingles") > 0).alias("words")).distinct()
    kept = keyed.join(stay, "key")
    return kept.where("words").dropDuplicates(["key"]).unionByName(kept.where("NOT words")).select("doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    packed = _packed(docs).withColumn("id", F.col("row.doc.doc_id"))
    found = suffix_dedup.dedup(packed, "id", "text", as_text=True)
    return _back(found.select(F.col("doc.row").alias("row"), "kept"), docs.columns, "row", F.col("kept"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by a mark."""
    found = secret_scan.scan(_packed(docs), id_col="row")
    return _back(found, docs.columns, "row", secret_scan.redact(F.col("text"), F.col("spans")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 4096 tokens."""
    return packing.pack(packing.token_pieces(docs, tokenizer_path("word_bpe_49k.json"), 1, 4096), 4096)
