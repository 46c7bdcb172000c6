"""Genome-annotation views over the driver's tables, for queries and their DuckDB oracles.

One template serves both engines: ``[[x]]`` is a double literal, ``DIV2`` integer halving, ``LETTERS(c)`` the letters
of a text.  ``{name}`` is another table or view.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annotspark.tables import dealt

TABLES = {"customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark", "conversations"}

VIEWS = {
    "fx_cds": """SELECT o_orderkey AS gid, concat('ctg', cast(o_custkey AS string)) AS seqid,
  CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand,
  CASE o_orderkey % 4 WHEN 0 THEN 'augustus' WHEN 1 THEN 'snap' WHEN 2 THEN 'genemark' ELSE 'protein' END AS source,
  CASE o_orderkey % 4 WHEN 0 THEN [[10.0]] WHEN 1 THEN [[3.0]] WHEN 2 THEN [[5.0]] ELSE [[20.0]] END AS weight,
  l_linenumber AS ord,
  1 + (o_orderkey * 7919) % 6000 + (l_linenumber - 1) * 200 + pk % 50 AS seg_start,
  1 + (o_orderkey * 7919) % 6000 + (l_linenumber - 1) * 200 + pk % 50 + 59 + q AS seg_end
FROM {orders} JOIN (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, cast(min(l_quantity) AS bigint) AS q
                  FROM {lineitem} GROUP BY l_orderkey, l_linenumber) l ON l_orderkey = o_orderkey""",
    "fx_gene": """SELECT gid, seqid, strand, source, weight, min(seg_start) AS g_start, max(seg_end) AS g_end,
  count(*) AS n_seg, cast(sum(seg_end - seg_start + 1) AS bigint) AS cds_len
FROM {fx_cds} GROUP BY gid, seqid, strand, source, weight""",
    "fx_ref": """SELECT gid, seqid, strand, ord, seg_start, seg_end + CASE WHEN gid % 5 = 0 THEN 3 ELSE 0 END AS seg_end
FROM {fx_cds} WHERE gid % 7 <> 0""",
    "fx_feature": """SELECT 1 AS lvl, gid, seqid, 'gene' AS type, g_start AS f_start, g_end AS f_end, strand, cast(NULL AS int) AS phase,
  concat('g', cast(gid AS string)) AS id, cast(NULL AS string) AS parent,
  CASE WHEN gid % 19 = 0 THEN NULL ELSE concat('LT', cast(gid AS string)) END AS locus_tag FROM {fx_gene}
UNION ALL SELECT 1, gid, seqid, 'gene', g_start, g_end, strand, NULL, concat('g', cast(gid AS string)), NULL, NULL FROM {fx_gene} WHERE gid % 13 = 0
UNION ALL SELECT 2, gid, seqid, 'mRNA', g_start, CASE WHEN gid % 17 = 0 THEN g_end - 10 ELSE g_end END, strand, NULL,
  concat('m', cast(gid AS string), '.1'), concat('g', cast(gid AS string)), NULL FROM {fx_gene} WHERE gid % 11 <> 0
UNION ALL SELECT 2, gid, seqid, 'mRNA', g_start, g_start + (g_end - g_start) DIV2, strand, NULL,
  concat('m', cast(gid AS string), '.2'), concat('g', cast(gid AS string)), NULL FROM {fx_gene} WHERE gid % 3 = 0
UNION ALL SELECT 3, gid, seqid, 'CDS', seg_start, seg_end, strand, CASE WHEN ord = 7 THEN NULL ELSE 0 END,
  concat('c', cast(gid AS string), '.', cast(ord AS string)), concat('m', cast(gid AS string), '.1'), NULL FROM {fx_cds}""",
    "fx_broken": """SELECT lvl, gid, seqid, type, f_start, f_end, strand, phase, CASE WHEN type IN ('gene', 'mRNA') AND gid % 23 = 0 THEN NULL ELSE id END AS id,
  CASE WHEN type = 'CDS' AND gid % 29 = 0 OR type = 'mRNA' AND gid % 37 = 0 THEN NULL WHEN type = 'CDS' AND gid % 41 = 0 THEN concat(parent, ',x')
  WHEN type = 'mRNA' AND gid % 43 = 0 THEN concat('c', cast(gid AS string), '.1') ELSE parent END AS parent, locus_tag FROM {fx_feature}""",
    "fx_seq": """SELECT doc_id AS seq_id, translate(LETTERS(text), 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'acgtacgtacgtacgtacgtacgtacACGTACGTACGTACGTACGTACGTAC') AS seq FROM {documents}""",
    "fx_ctg": """SELECT concat('ctg', cast(c_custkey AS string)) AS seqid,
  substr(repeat(upper(seq), cast(ceil(8000 / cast(length(seq) AS double)) AS int)), 1, 8000) AS seq
FROM {customer} JOIN {fx_seq} ON seq_id = c_custkey % 200 WHERE length(seq) > 0""",
    "fx_hits": """SELECT concat('LT', cast(l_orderkey AS string)) AS query, concat('T', cast(l_partkey AS string)) AS target,
  CASE l_returnflag WHEN 'A' THEN 'homology' WHEN 'N' THEN 'domain' ELSE 'family' END AS source,
  [[100.0]] - l_discount * 500 AS identity, cast(l_linenumber AS double) / 1000 AS evalue, l_extendedprice AS bitscore,
  100 + l_suppkey % 50 AS dom_len, 1 AS hmm_from, 1 + cast(l_quantity AS bigint) * 2 AS hmm_to,
  cast(l_orderkey AS bigint) * 1000000 + l_linenumber * 100000 + l_suppkey AS pos, l_partkey AS partkey FROM {lineitem}""",
    "fx_quant": """SELECT concat('tx', cast(l_partkey AS string)) AS transcript, concat('s', cast(l_suppkey % 6 AS string)) AS sample,
  CASE WHEN l_suppkey % 6 < 3 THEN 'control' ELSE 'treated' END AS condition,
  sum(l_quantity) AS num_reads, sum(l_quantity) / 10 AS tpm FROM {lineitem} GROUP BY l_partkey, l_suppkey % 6""",
    "fx_hap": """SELECT concat('tx', cast(l_partkey AS string)) AS transcript, concat('s', cast(l_suppkey % 3 AS string)) AS sample,
  CASE l_linestatus WHEN 'O' THEN 'hap0' ELSE 'hap1' END AS hap, sum(l_quantity) AS num_reads FROM {lineitem}
GROUP BY l_partkey, l_suppkey % 3, l_linestatus""",
    "fx_ortho": """SELECT DISTINCT concat('OG', cast(l_partkey AS string)) AS og, concat('G', cast(l_orderkey % 5 AS string)) AS genome,
  concat('g', cast(l_orderkey AS string)) AS gene FROM {lineitem} WHERE l_linenumber <= 1 + l_partkey % 3""",
    "fx_vcf": """SELECT concat('ctg', cast(user_id AS string)) AS chrom, 1 + (event_id * 37) % 7000 AS pos,
  concat(substr('ACGT', cast(event_id % 4 AS int) + 1, 1), CASE event_id % 9 WHEN 3 THEN 'GT' WHEN 4 THEN 'C' WHEN 5 THEN 'ACC' ELSE '' END) AS ref,
  CASE event_id % 9 WHEN 0 THEN 'A,C' WHEN 1 THEN '<DEL>' WHEN 2 THEN 'ACGTA' WHEN 3 THEN substr('ACGT', cast(event_id % 4 AS int) + 1, 1) WHEN 4 THEN 'GT' WHEN 5 THEN 'TA' ELSE substr('CGTA', cast(event_id % 4 AS int) + 1, 1) END AS alt,
  CASE event_id % 5 WHEN 0 THEN './.' WHEN 1 THEN '1|1' WHEN 2 THEN '1|0' ELSE '0|1' END AS gt, event_type AS filter_tag, event_id FROM {events}""",
    "fx_go": """SELECT concat('tx', cast(p_partkey AS string)) AS gene, concat('GO:', lpad(cast(p_size AS string), 7, '0')) AS go,
  CASE p_size % 3 WHEN 0 THEN 'BP' WHEN 1 THEN 'MF' ELSE 'CC' END AS ontology, (p_partkey % 100) / [[100.0]] AS padj FROM {part}""",
    "fx_paf": """SELECT concat('ctg', cast(l_suppkey AS string)) AS qname, 1000 + l_suppkey % 7 * 100 AS qlen, l_linenumber * 10 AS q_start, 1000 AS q_end,
  concat('ctg', cast(l_partkey % 50 AS string)) AS tname, 1000 + (l_partkey % 50) % 7 * 100 AS tlen, 5 AS t_start,
  5 + cast(l_quantity AS bigint) * 20 - l_linenumber % 3 AS t_end, cast(l_quantity AS bigint) * 19 AS matches, cast(l_quantity AS bigint) * 20 AS block FROM {lineitem}""",
    "fx_runs": "SELECT event_type AS tool, user_id AS genome, event_id % 3 AS rep, value AS metric, event_id AS pos, ts FROM {events}",
}


def _needs(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def _spark_sql(sql: str, **views: DataFrame) -> DataFrame:
    text = re.sub(r"LETTERS\((\w+)\)", r"regexp_replace(\1, '[^A-Za-z]', '')", sql.replace("DIV2", "div 2"))
    text = re.sub(r"\[\[([\d.]+)\]\]", r"\1D", text)
    spark = next(iter(views.values())).sparkSession
    return spark.sql(text, **views)


def _cds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_cds with both tables dealt by order before anything is gathered: no task holds more orders as the tables grow."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    rows = lines.count()  # of Parquet, from the files' footers
    return _spark_sql(VIEWS["fx_cds"], orders=dealt(table(spark, sf_dir, "orders"), "o_orderkey", rows), lineitem=dealt(lines, "l_orderkey", rows))


def _feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_feature with each order's lines gathered once and joined as one row, in place of four looks at genes and one at segments.

    Orders of one key, customer and strand are one gene with each line's segment as often as there are such orders.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    rows = lines.count()  # of Parquet, from the files' footers
    own = _spark_sql("SELECT o_orderkey AS gid, concat('ctg', cast(o_custkey AS string)) AS seqid, CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand FROM {orders}", orders=dealt(table(spark, sf_dir, "orders"), "o_orderkey", rows))
    own = own.groupBy("gid", "seqid", "strand").agg(F.count("*").cast("int").alias("_times"))
    segs = _spark_sql("SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, cast(min(l_quantity) AS bigint) AS q FROM {lineitem} GROUP BY l_orderkey, l_linenumber", lineitem=dealt(lines, "l_orderkey", rows))
    segs = segs.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "pk", "q")).alias("_l"))
    begin = "1 + (gid * 7919) % 6000 + (x.l_linenumber - 1) * 200 + x.pk % 50"
    segs = own.join(segs, own["gid"] == segs["l_orderkey"]).withColumn("_s", F.expr(f"transform(_l, x -> struct(x.l_linenumber AS ord, {begin} AS seg_start, {begin} + 59 + x.q AS seg_end))"))
    gene = segs.select("gid", "seqid", "strand", "_times", "_s", F.array_min("_s.seg_start").alias("g_start"), F.array_max("_s.seg_end").alias("g_end"))
    text = F.col("gid").cast("string")
    none = F.lit(None).cast("string")
    g, up = F.concat(F.lit("g"), text), F.concat(F.lit("m"), text, F.lit(".1"))
    row = lambda lvl, type_, start, end, phase, own, parent, tag: F.struct(F.lit(lvl).alias("lvl"), F.lit(type_).alias("type"), start.alias("f_start"), end.alias("f_end"), phase.cast("int").alias("phase"), own.alias("id"), parent.alias("parent"), tag.alias("locus_tag"))
    start, end, k, no = F.col("g_start"), F.col("g_end"), F.col("gid"), F.lit(None)
    tops = F.array(
        row(1, "gene", start, end, no, g, none, F.when(k % 19 != 0, F.concat(F.lit("LT"), text))),
        F.when(k % 13 == 0, row(1, "gene", start, end, no, g, none, none)),
        F.when(k % 11 != 0, row(2, "mRNA", start, F.when(k % 17 == 0, end - 10).otherwise(end), no, up, g, none)),
        F.when(k % 3 == 0, row(2, "mRNA", start, F.expr("g_start + (g_end - g_start) div 2"), no, F.concat(F.lit("m"), text, F.lit(".2")), g, none)),
    )
    phase = lambda x: F.when(F.coalesce(x["ord"] != 7, F.lit(True)), 0)
    low = F.transform("_s", lambda x: row(3, "CDS", x["seg_start"], x["seg_end"], phase(x), F.concat(F.lit("c"), text, F.lit("."), x["ord"].cast("string")), up, none))
    low = F.when(F.col("_times") == 1, low).otherwise(F.flatten(F.transform(F.sequence(F.lit(1), F.col("_times")), lambda _: low)))
    made = gene.select("gid", "seqid", "strand", F.explode(F.concat(F.array_compact(tops), low)).alias("x"))
    return made.select("x.lvl", "gid", "seqid", "x.type", "x.f_start", "x.f_end", "strand", "x.phase", "x.id", "x.parent", "x.locus_tag")


#: Contigs of 8,000 bases made in one task.
CONTIGS = 8192


def _ctg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_ctg with the sequence of each of the at most 399 remainders made once, and customers dealt to tasks of a fixed size."""
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    named = customer.select((F.col("c_custkey") % 200).cast("bigint").alias("doc_id")).distinct()
    seqs = _spark_sql(VIEWS["fx_seq"], documents=table(spark, sf_dir, "documents").select("doc_id", "text").join(F.broadcast(named), "doc_id", "left_semi"))
    base = F.expr("substr(repeat(upper(seq), cast(ceil(8000 / cast(length(seq) AS double)) AS int)), 1, 8000)")
    seqs = seqs.where("length(seq) > 0").select("seq_id", base.alias("seq"))
    keys = dealt(customer, "c_custkey", customer.count(), CONTIGS).withColumn("seq_id", (F.col("c_custkey") % 200).cast("bigint"))
    return keys.join(F.broadcast(seqs), "seq_id").select(F.concat(F.lit("ctg"), F.col("c_custkey").cast("string")).alias("seqid"), "seq")


#: Views whose template, run as it stands, would gather too much in one task, or make the same thing over and over.
_BUILT = {"fx_cds": _cds, "fx_feature": _feature, "fx_ctg": _ctg}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a view, as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in _BUILT:
        return _BUILT[name](spark, sf_dir)
    return _spark_sql(VIEWS[name], **{n: table(spark, sf_dir, n) for n in _needs(VIEWS[name])})


def oracle(body: str) -> str:
    """DuckDB SQL: the views that ``body`` names, as CTEs before it."""
    done: dict[str, str] = {}

    def add(sql: str) -> None:
        for n in re.findall(r"\bfx_\w+", sql):
            if n in VIEWS and n not in done:
                add(VIEWS[n])
                text = re.sub(r"LETTERS\((\w+)\)", r"regexp_replace(\1, '[^A-Za-z]', '', 'g')", VIEWS[n].replace("DIV2", "// 2"))
                text = re.sub(r"\[\[([\d.]+)\]\]", r"CAST(\1 AS double)", text)
                done.setdefault(n, re.sub(r"\{(\w+)\}", r"\1", text))

    add(body)
    if not done:
        return body
    head = ", ".join(f"{n} AS ({sql})" for n, sql in done.items())
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", body)
    return f"WITH {own[1] or ''}{head}, {body[own.end():]}" if own else f"WITH {head} {body}"
