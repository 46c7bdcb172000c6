import re

import corpus_pipeline
from annotspark.llm import quality_rules, secret_scan, stages, suffix_dedup
from tests.llm.test_ngram_join import brute as groups
from tests.llm.test_secret_scan import brute as spans


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_each_stage_against_brute_force(spark, sample):
    docs = sample
    columns = docs.columns
    out = stages.quality(spark, docs, "")
    assert out.columns == columns
    bad = {r["doc_id"] for r in quality_rules.ledger(docs).where("fail_bits <> 0").collect()}
    assert set(texts(out)) == set(texts(docs)) - bad

    before = texts(out)
    near = stages.near_duplicates(spark, out, "")
    assert near.columns == columns
    assert set(texts(near)) == {int(c) for _, _, c in groups(list(before.items()))}

    before = texts(near)
    cut = texts(stages.repeated_passages(spark, near, ""))
    want = {i: n - g for i, n, g, _, _ in suffix_dedup.brute_force(list(before.items()))}
    assert all(want[i] - 8 <= len(t.encode()) <= want[i] for i, t in cut.items()) and len(cut) == len(before)

    clean = texts(stages.secrets(spark, near, ""))
    for i, t in before.items():
        found = spans(t)
        if not found:
            assert clean[i] == t
        else:
            assert "[SECRET]" in clean[i] and len(clean[i]) < len(t) + 8 * len(found)
            assert not any(t[a:b] in clean[i] for a, _, b in found)


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").toPandas().sort_values(["sequence_id", "offset"])
    fill = out.groupby("sequence_id")["length"]
    assert fill.sum().max() <= 4096
    assert (fill.cumsum() - out["length"] == out["offset"]).all()


def test_nulls_pass(spark, tricky):
    docs = tricky.select("doc_id", "text", "kept")
    for stage in (stages.repeated_passages, stages.secrets):
        rows = stage(spark, docs, "").collect()
        assert len(rows) == docs.count() and sum(r["text"] is None for r in rows) == 1
    rows = stages.near_duplicates(spark, docs, "").collect()
    assert len([r for r in rows if r["doc_id"] == 5]) == 1 and re.match("x", rows[0]["kept"])


def test_secret_rules_are_listed():
    assert [r.kind for r in secret_scan.RULES[:3]] == ["assign", "access", "hex"]


def test_clashing_names_and_empty_tables(spark, tricky):
    """Columns named as those that the stages and operators make for themselves, and tables without rows."""
    clash = ["_null", "_hash", "_key", "_id", "_words", "_row", "_doc", "row", "doc", "key", "words", "kept", "spans", "label", "cls", "n", "n_chars"]
    docs = tricky.selectExpr("doc_id", "text", *[f"'{c}' AS `{c}`" if c != "n_chars" else "length(text) AS n_chars" for c in clash])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert all(r[c] == c for c in clash if c != "n_chars") and r["n_chars"] == (None if r["text"] is None else len(r["text"])), name
        assert stage(spark, docs.limit(0), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), "").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
