"""Text, rules and retrieval."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.registry import query
from annotspark.tables import let, written


def terms(text):
    """Lower-cased terms of over two letters, digits or underscores."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9_]+"), lambda t: F.length(t) > 2)


def bm25(docs: DataFrame, doc_id: str, text: str, asked: str, k: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """The k best documents for a query text.  Only terms of the query are counted per document; the query is a literal."""
    asked_terms = [t for t in re.split("[^a-z0-9_]+", asked.lower()) if len(t) > 2]
    # each text is split once: its length and the query's terms in it are what both the statistics and the counts need
    found = docs.select(doc_id, let(terms(F.col(text)), lambda t: F.struct(F.size(t).alias("len"), F.filter(t, lambda x: x.isin(*asked_terms)).alias("hits"))).alias("_t"))
    found = written(found.select(doc_id, "_t.len", "_t.hits"), "terms")
    wanted = docs.sparkSession.range(1).select(F.explode(terms(F.lit(asked))).alias("term")).groupBy("term").agg(F.count("*").alias("q"))
    stats = found.agg(F.count("*").alias("docs"), F.avg("len").alias("mean"))
    tf = found.select(doc_id, "len", F.explode("hits").alias("term")).join(F.broadcast(wanted), "term")  # the query's terms
    tf = tf.groupBy(doc_id, "len", "term", "q").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    rows = tf.join(df, "term").crossJoin(stats)  # one row
    idf = F.greatest(F.lit(0.0), F.log((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1))
    part = F.col("q") * idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    return rows.groupBy(doc_id).agg(F.round(F.sum(part), 6).alias("score")).where("score > 0").orderBy(F.desc("score"), doc_id).limit(k)


_ASK = "the and with that license"
_TERMS = "list_filter(regexp_split_to_array(lower({}), '[^a-z0-9_]+'), lambda t: length(t) > 2)"


@query("R01_bm25_search", "documents", f"""WITH w AS (SELECT doc_id, {_TERMS.format("text")} AS t FROM documents), s AS (SELECT count(*) AS docs, avg(len(t)) AS mean FROM w),
q AS (SELECT term, count(*) AS q FROM (SELECT unnest({_TERMS.format(f"'{_ASK}'")}) AS term) GROUP BY term),
tf AS (SELECT doc_id, len, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS len, unnest(t) AS term FROM w) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3), d AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT doc_id, round(sum(q.q * greatest(0.0, ln((docs - df + 0.5) / (df + 0.5) + 1)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 6) AS score
FROM tf JOIN d ON d.term = tf.term JOIN q ON q.term = tf.term, s GROUP BY doc_id HAVING score > 0 ORDER BY score DESC, doc_id LIMIT 10""")  # fmt: skip
def r01(docs):
    return bm25(docs, "doc_id", "text", _ASK)


@query("R02_split_paragraphs", "documents", """SELECT doc_id, CAST(i AS BIGINT) AS n, left(p, 500) AS snippet FROM (SELECT doc_id, unnest(l) AS p, unnest(range(0, len(l))) AS i FROM
(SELECT doc_id, list_filter(string_split(text, chr(10) || chr(10)), lambda x: strlen(regexp_replace(x, '^\\s+|\\s+$', '', 'g')) > 50) AS l FROM documents))""")  # fmt: skip
def r02(docs):
    """Paragraphs between blank lines, of more than 50 bytes without the white space around them."""
    parts = F.filter(F.split("text", "\n\n"), lambda x: F.octet_length(F.regexp_replace(x, r"(?U)^\s+|\s+\z", "")) > 50)
    return docs.select("doc_id", F.posexplode(parts).alias("n", "p")).select("doc_id", F.col("n").cast("long").alias("n"), F.substring("p", 1, 500).alias("snippet"))


#: Rule table: field, comparison, threshold, severity.
RULES = [("genes", "lt", 5000.0, "warning"), ("genes", "gt", 10.0, "info"), ("mean_len", "gte", 500.0, "info"), ("mean_len", "lt", 100.0, "error"), ("single", "eq", 0.0, "error")]


def threshold_rules(stats: DataFrame, rules: DataFrame) -> DataFrame:
    """Findings of a rule table on (field, value) rows."""
    met = stats.join(F.broadcast(rules), "field")  # the rule table
    v, t = F.col("value"), F.col("threshold")
    hit = F.when(F.col("op") == "gt", v > t).when(F.col("op") == "lt", v < t).when(F.col("op") == "gte", v >= t).when(F.col("op") == "lte", v <= t).otherwise(v == t)
    return met.where(hit)


@query("R03_threshold_rules", "fx_gene", """WITH s AS (SELECT 'genes' AS field, CAST(count(*) AS DOUBLE) AS value FROM fx_gene UNION ALL SELECT 'mean_len', avg(g_end - g_start + 1) FROM fx_gene UNION ALL SELECT 'single', CAST(count(*) FILTER (WHERE n_seg = 1) AS DOUBLE) FROM fx_gene),
r(field, op, threshold, severity) AS (VALUES ('genes', 'lt', 5000.0, 'warning'), ('genes', 'gt', 10.0, 'info'), ('mean_len', 'gte', 500.0, 'info'), ('mean_len', 'lt', 100.0, 'error'), ('single', 'eq', 0.0, 'error'))
SELECT s.field, op, severity, round(value, 6) AS value FROM s JOIN r ON s.field = r.field WHERE CASE op WHEN 'gt' THEN value > threshold WHEN 'lt' THEN value < threshold WHEN 'gte' THEN value >= threshold ELSE value = threshold END""")  # fmt: skip
def r03(genes):
    one = genes.agg(F.count("*").cast("double").alias("genes"), F.avg(F.col("g_end") - F.col("g_start") + 1).alias("mean_len"), F.count_if(F.col("n_seg") == 1).cast("double").alias("single"))
    stats = one.unpivot([], ["genes", "mean_len", "single"], "field", "value")
    rules = genes.sparkSession.createDataFrame(RULES, "field string, op string, threshold double, severity string")
    return threshold_rules(stats, rules).select("field", "op", "severity", F.round("value", 6).alias("value"))


@query("R04_stage_rules", "fx_runs", "SELECT tool AS stage, CASE WHEN avg(metric) < 40 THEN 'low' WHEN avg(metric) > 60 THEN 'high' ELSE 'ok' END AS finding FROM fx_runs GROUP BY tool")
def r04(runs):
    m = F.avg("metric")
    return runs.groupBy(F.col("tool").alias("stage")).agg(F.when(m < 40, "low").when(m > 60, "high").otherwise("ok").alias("finding"))


def log_counts(lines: DataFrame, key: str) -> DataFrame:
    """(key, errors, warnings): lines that say ERROR or WARNING."""
    return lines.groupBy(key).agg(F.count_if(F.contains("value", F.lit("ERROR"))).alias("errors"), F.count_if(F.contains("value", F.lit("WARNING"))).alias("warnings"))


@query("R05_log_line_counts", "fx_runs", "SELECT tool, count(*) FILTER (WHERE pos % 7 = 0) AS errors, count(*) FILTER (WHERE pos % 5 = 0 AND pos % 7 <> 0 OR pos % 35 = 0) AS warnings FROM fx_runs GROUP BY tool")
def r05(runs):
    """Log lines of the runs: an error in every seventh, a warning in every fifth, both in every thirty-fifth."""
    said = F.when(F.col("pos") % 35 == 0, "ERROR after WARNING").when(F.col("pos") % 7 == 0, "ERROR").when(F.col("pos") % 5 == 0, "WARNING").otherwise("info, no Error or warning")
    return log_counts(runs.select("tool", F.concat(F.lit("["), F.col("ts").cast("string"), F.lit("] "), said, F.lit(": metric "), F.col("metric").cast("string")).alias("value")), "tool")


#: What error reports and log lines look like.
_REPORT = r"(?i)\b(SEQ_FEAT|FATAL|error|invalid|missing required)\b"
_LOG = r"(?i)^\s*(\[?\d{4}-\d{2}-\d{2}|\[?(info|warn(ing)?|error|debug)\b)"


def text_format(text: Column) -> Column:
    """What a pasted text is, by its first 20 lines: a nine-column row, a sequence header, an error report, log lines, or unknown."""
    head = F.slice(F.split(text, "\n"), 1, 20)
    some = lambda f: F.exists(head, f)
    logs = F.size(F.filter(head, lambda x: x.rlike(_LOG)))
    return (
        F.when(some(lambda x: ~x.startswith("#") & (F.size(F.split(x, "\t")) == 9)), "gff3").when(some(lambda x: x.startswith(">")), "fasta")
        .when(logs >= 2, "log").when(some(lambda x: x.rlike(_REPORT)), "validation").otherwise("unknown")
    )


@query("R06_classify_text_format", "documents", r"""WITH d AS (SELECT doc_id, string_split(concat(CASE CAST(doc_id % 7 AS INTEGER) WHEN 0 THEN concat_ws(chr(9), 'c', 's', 'gene', '1', '9', '.', '+', '.', 'ID=a') || chr(10) || '# note' WHEN 1 THEN '>seq one'
WHEN 2 THEN '2024-05-01 start' || chr(10) || '[INFO] read' WHEN 3 THEN 'SEQ_FEAT.NoStop' WHEN 4 THEN 'it says: Invalid row' WHEN 5 THEN 'terrors and errorless words, warnings too' ELSE '' END, chr(10), text), chr(10))[1:20] AS l FROM documents)
SELECT doc_id, CASE WHEN len(list_filter(l, lambda x: left(x, 1) <> '#' AND len(string_split(x, chr(9))) = 9)) > 0 THEN 'gff3' WHEN len(list_filter(l, lambda x: left(x, 1) = '>')) > 0 THEN 'fasta'
WHEN len(list_filter(l, lambda x: regexp_matches(x, '(?i)^\s*(\[?\d{4}-\d{2}-\d{2}|\[?(info|warn(ing)?|error|debug)\b)'))) >= 2 THEN 'log'
WHEN len(list_filter(l, lambda x: regexp_matches(x, '(?i)\b(SEQ_FEAT|FATAL|error|invalid|missing required)\b'))) > 0 THEN 'validation' ELSE 'unknown' END AS format FROM d""")  # fmt: skip
def r06(docs):
    """Documents behind a line or two of each kind in turn, and of words that only look like a report's."""
    row = F.lit("c\ts\tgene\t1\t9\t.\t+\t.\tID=a\n# note")
    said = ["2024-05-01 start\n[INFO] read", "SEQ_FEAT.NoStop", "it says: Invalid row", "terrors and errorless words, warnings too", ""]
    head = F.get(F.array(row, F.lit(">seq one"), *map(F.lit, said)), (F.col("doc_id") % 7).cast("int"))
    return docs.select("doc_id", text_format(F.concat(head, F.lit("\n"), "text")).alias("format"))


#: Fixed extensions by format.
EXTENSIONS = {"gff3": ["gff", "gff3"], "gtf": ["gtf"], "fasta": ["fa", "fasta", "fna", "faa", "ffn"], "genbank": ["gb", "gbk", "gbff", "genbank"]}


def detect_format(name: Column, text: Column) -> Column:
    """By a file's extension (before a .gz), else by its first line that says something."""
    ending = F.lower(F.regexp_extract(F.regexp_replace(name, r"(?i)\.gz$", ""), r"\.([^./]+)$", 1))
    known = F.try_element_at(F.create_map(*[F.lit(x) for f, es in EXTENSIONS.items() for e in es for x in (e, f)]), ending)
    first = F.get(F.filter(F.split(text, "\r?\n"), lambda x: (F.trim(x) != "") & (~x.startswith("#") | x.startswith("##gff-version"))), F.lit(0))
    told = (
        F.when(first.startswith(">"), "fasta").when(first.startswith("LOCUS"), "genbank").when(first.startswith("##gff-version"), "gff3")
        .when(F.contains(first, F.lit('gene_id "')), "gtf").when(F.size(F.split(first, "\t")) == 9, "gff3").otherwise("unknown")
    )
    return F.coalesce(known, told, F.lit("unknown"))


@query("S29_detect_format", "documents", """SELECT doc_id, CASE CAST(doc_id % 8 AS INTEGER) WHEN 0 THEN 'gff3' WHEN 1 THEN 'genbank' WHEN 2 THEN 'fasta' WHEN 3 THEN 'genbank' WHEN 4 THEN 'gff3' WHEN 5 THEN 'gtf' WHEN 6 THEN 'gff3' ELSE 'unknown' END AS format FROM documents""")
def s29(docs):
    """Documents as files: two told by their extension, the others by a line behind blank and comment lines."""
    kind = (F.col("doc_id") % 8).cast("int")
    names = [F.lit(x) for x in ("a.GFF3.gz", "b.v1.gbk", "c.txt", "d", "e.1", "f.tmp", "g", "h.md")]
    tab = F.lit("c\ts\tgene\t1\t9\t.\t+\t.\t")
    lines = [F.lit(">x"), F.lit(">x"), F.lit(">x"), F.lit("LOCUS x"), F.lit("##gff-version 3"), F.concat(tab, F.lit('gene_id "a";')), F.concat(tab, F.lit("ID=a")), F.lit("plain words")]
    text = F.concat(F.lit("\n# comment\n  \n"), F.get(F.array(*lines), kind), F.lit("\n"), "text")
    return docs.select("doc_id", detect_format(F.get(F.array(*names), kind), text).alias("format"))


#: Ordered screening rules.
SCREEN = [(1, "number", "[0-9]{4}"), (2, "question", "\\?"), (3, "long", "^.{400}")]


@query("R07_pattern_screen", "conversations", """SELECT conv_id, turn, CASE WHEN regexp_matches(lower(text), '[0-9]{4}') THEN 'number' WHEN regexp_matches(lower(text), '\\?') THEN 'question' WHEN regexp_matches(lower(text), '^.{400}') THEN 'long' ELSE 'pass' END AS verdict FROM conversations""")
def r07(rows):
    low = F.lower("text")
    out = None
    for _, name, pattern in sorted(SCREEN):
        out = F.when(low.rlike(pattern), name) if out is None else out.when(low.rlike(pattern), name)
    return rows.select("conv_id", "turn", out.otherwise("pass").alias("verdict"))


def known_commands(text: Column, program: str, allowed: list[str]) -> Column:
    """(text, kept, removed, valid): the text without the lines that name a command of the program outside the list."""
    named = lambda line: F.regexp_extract_all(line, F.lit(rf"(?:^|[\s`$]){program}\s+([a-z][a-z0-9-]*)"), F.lit(1))
    fine = lambda line: F.forall(named(line), lambda c: c.isin(*allowed))
    return let(F.split(text, "\n"), lambda lines: let(F.filter(lines, fine), lambda kept: F.struct(F.array_join(kept, "\n").alias("text"), F.size(kept).cast("long").alias("kept"), (F.size(lines) - F.size(kept)).cast("long").alias("removed"), (F.size(lines) == F.size(kept)).alias("valid"))))


@query("R08_drop_unknown_commands", "conversations", """SELECT conv_id, turn, CAST(len(string_split(text, chr(10))) + 2 - CASE WHEN conv_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS kept, CAST(CASE WHEN conv_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS removed, conv_id % 3 <> 0 AS valid, length(text) AS rest FROM conversations""")
def r08(rows):
    """Turns behind a line with a known command and one with a known or an unknown one."""
    second = F.when(F.col("conv_id") % 3 == 0, "run annot clean and `annot destroy`\n").otherwise("run annot clean\n")
    found = rows.select("conv_id", "turn", "text", known_commands(F.concat(F.lit("$ annot stats x\n"), second, "text"), "annot", ["stats", "clean", "convert"]).alias("x"))
    first = F.length(F.lit("$ annot stats x\n")) + F.when(F.col("conv_id") % 3 == 0, 0).otherwise(F.length(F.lit("run annot clean\n")))
    return found.select("conv_id", "turn", "x.kept", "x.removed", "x.valid", (F.length("x.text") - first).alias("rest"))


@query("P17_sanitise_names", "documents", "SELECT doc_id, regexp_replace(text, '[^A-Za-z0-9_\\-\"=/ \\t]', '_', 'g') AS clean FROM documents")
def p17(docs):
    return docs.select("doc_id", F.regexp_replace("text", r"[^A-Za-z0-9_\-\"=/ \t]", "_").alias("clean"))
