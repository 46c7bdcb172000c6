"""Thin contract queries over the corpus operators."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotspark.llm import byte_bpe, embed_dedup, hard_negatives, license_scan, line_quality, ngram_join, packing, periodic_runs, quality_rules, secret_scan, suffix_dedup, warc, wavelet
from annotspark.llm.common import read, shared_dir, written
from annotspark.llm.tokens import tokenizer_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents")).select("doc_id", "spans")
    of = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] < 3)
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{r.kind}") for k, r in enumerate(secret_scan.RULES) if r.base],
        F.sha2(secret_scan.shown(base), 256).alias("base_sha256"),
        secret_scan.shown(F.col("spans")).alias("spans"),
    )


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the rules are evaluated once, into a stored ledger; policies and ablations read that
    book = written(quality_rules.ledger(read(spark, sf_dir, "documents")), "ledger")
    base = F.col("fail_bits").bitwiseAND(F.lit(quality_rules.mask_of("v1"))) != 0
    return quality_rules.apply_policy(book, "v2").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits", quality_rules.only_rule("v2").alias("only_rule")
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    return byte_bpe.encode(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN, keep_ids=False)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(read(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 1, 4096)
    return packing.pack(pieces, 4096)


def op5_wavelet_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = wavelet.export(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 2)
    return wavelet.read_shards(manifest, folder, decode=_crc32, fields="ids_crc32 long")


def _crc32(ids) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), folder)
    # the record type is pushed into the reader: responses are told by the payload that was read, revisits by their headers
    responses = warc.read(spark, folder).where("record_type = 'response'")
    revisits = warc.read(spark, folder, payload=False).where("record_type = 'revisit'")
    told = responses.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), warc.base32_sha1(F.col("payload")).alias("payload_digest"), "record_type", "refers_to"
    )
    return told.unionByName(revisits.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup(read(spark, sf_dir, "documents")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = line_quality.train(docs, read(spark, sf_dir, "labels"), ~line_quality.held_out(F.col("id")))
    # a null id has no remainder: such a row is scored, and not held out
    held = F.coalesce(line_quality.held_out(F.col("doc_id")), F.lit(False))
    found = line_quality.score(docs, model)
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_lines")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.stretched(read(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.periodic_runs(docs, collapsed=False))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.contract_vectors(read(spark, sf_dir, "embeddings"))
    return hard_negatives.hard_negatives(vectors, F.col("id") % 50 == 0)


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_wavelet_ids": op5_wavelet_ids,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_warc": op8_warc,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_quality_classifier": op11_quality_classifier,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES = {"op3_quality_rules": quality_rules.ORACLE, "op8_warc": warc.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
