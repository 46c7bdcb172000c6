import hashlib
import re

from pyspark.sql import functions as F

from annotspark.llm import secret_scan as ss


def brute(text, rules=ss.RULES):
    out = []
    for k, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def got(df):
    return sorted((str(r["doc_id"]), [tuple(x) for x in r["spans"]]) for r in df.collect())


def test_matches_brute_force(tricky, sample):
    for docs in (tricky, sample):
        want = sorted((str(r["doc_id"]), brute(r["text"])) for r in docs.select("doc_id", "text").collect())
        assert got(ss.scan(docs)) == want


def test_empty_table(tricky):
    assert ss.scan(tricky.limit(0)).count() == 0


def test_trigram_queries():
    assert ss.trigram_query(r"AKIA[A-Z0-9]+") == [[["aki", "kia"]]]
    assert ss.trigram_query(r"[0-9a-f]+") == []
    clause = ss.trigram_query(r"(?i)(token|api_?key)=")[0]
    assert ["api", "ey=", "ike", "key", "pik"] in clause and len(clause) == 3


def test_redaction(spark):
    df = spark.createDataFrame([(1, "é token=abcdefgh1 end")], "doc_id long, text string")
    row = ss.scan(df).select(ss.redact(F.col("text"), F.col("spans")).alias("t")).first()
    assert row["t"] == "é [SECRET] end"


def test_digest_of_nothing(spark):
    from annotspark.llm import queries

    d = spark.createDataFrame([(1, None)], "doc_id long, text string")
    row = ss.scan(d).select(F.sha2(ss.shown(F.col("spans")), 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"").hexdigest()
    assert "op1_secret_scan" in queries.QUERIES
