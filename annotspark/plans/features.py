"""Counts, lengths, filters and checks of feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annotspark.registry import query
from annotspark.tables import written

COUNTS = {"genes": "type = 'gene'", "transcripts": "type IN ('mRNA', 'transcript')", "cds": "type = 'CDS'", "exons": "type = 'exon'"}
_COUNT_SQL = ", ".join(f"count(*) FILTER (WHERE {c}) AS n_{k}" for k, c in COUNTS.items())


def feature_counts(features: DataFrame, *keys: str) -> DataFrame:
    """Totals of features, genes, transcripts, CDS and exons in one pass, over all or per key."""
    return features.groupBy(*keys).agg(F.count("*").alias("n_features"), *[F.count_if(F.expr(c)).alias(f"n_{k}") for k, c in COUNTS.items()])


@query("A01_feature_counts", "fx_feature", f"SELECT count(*) AS n_features, {_COUNT_SQL} FROM fx_feature")
def a01(features):
    return feature_counts(features)


@query("A02_per_chromosome_counts", "fx_feature", f"SELECT seqid, count(*) AS n_features, {_COUNT_SQL} FROM fx_feature GROUP BY seqid")
def a02(features):
    return feature_counts(features, "seqid")


def length_summary(df: DataFrame, length) -> DataFrame:
    """Mean, exact median, least and greatest; zeros when empty."""
    zero = lambda c: F.coalesce(c, F.lit(0))
    n = df.select(length.alias("n"))
    return n.agg(F.count("*").alias("n"), F.round(zero(F.avg("n")), 6).alias("mean"), zero(F.percentile("n", F.lit(0.5))).alias("median"), zero(F.min("n")).alias("least"), zero(F.max("n")).alias("greatest"))


_SUMMARY = "SELECT count(*) AS n, round(coalesce(avg(n), 0), 6) AS mean, coalesce(median(n), 0) AS median, coalesce(min(n), 0) AS least, coalesce(max(n), 0) AS greatest FROM ({})"


@query("A03_length_summary", "fx_gene", _SUMMARY.format("SELECT g_end - g_start + 1 AS n FROM fx_gene"))
def a03(genes):
    return length_summary(genes, F.col("g_end") - F.col("g_start") + 1)


def n50(df: DataFrame, keys: list[str], length: str) -> DataFrame:
    """Per key the length at which the longest first reach half of the total.

    Equal lengths are counted together, so the window runs over distinct lengths of one genome.
    """
    sizes = df.groupBy(*keys, length).agg((F.sum(length)).alias("_sum"))
    down = Window.partitionBy(*keys).orderBy(F.desc(length)).rowsBetween(Window.unboundedPreceding, 0)
    cum = sizes.withColumn("_cum", F.sum("_sum").over(down)).withColumn("_all", F.sum("_sum").over(Window.partitionBy(*keys)))
    return cum.where(F.col("_cum") >= F.floor(F.col("_all") / 2)).groupBy(*keys).agg(F.max(length).alias("n50"))


@query("A04_n50", "fx_gene", """SELECT source, max(n) AS n50 FROM (SELECT source, n, sum(n) OVER (PARTITION BY source ORDER BY n DESC, gid ROWS UNBOUNDED PRECEDING) AS c,
sum(n) OVER (PARTITION BY source) AS t FROM (SELECT source, gid, g_end - g_start + 1 AS n FROM fx_gene)) WHERE c >= t // 2 GROUP BY source""")  # fmt: skip
def a04(genes):
    return n50(genes.withColumn("n", F.col("g_end") - F.col("g_start") + 1), ["source"], "n")


_ISO = "SELECT g.gid, count(m.id) AS n FROM (SELECT DISTINCT gid, id FROM fx_feature WHERE type = 'gene') g LEFT JOIN fx_feature m ON m.parent = g.id AND m.type = 'mRNA' GROUP BY g.gid"


def isoforms(features: DataFrame) -> DataFrame:
    """(gid, n): transcripts of every gene, genes without any included."""
    genes = features.where("type = 'gene'").select("gid", F.col("id").alias("gene")).distinct()
    tx = features.where("type = 'mRNA'").groupBy(F.col("parent").alias("gene")).agg(F.count("*").alias("n"))
    return genes.join(tx, "gene", "left").select("gid", F.coalesce("n", F.lit(0)).alias("n"))


@query("A05_isoform_distribution", "fx_feature", f"""SELECT count(*) AS genes, round(avg(n), 6) AS mean_isoforms, count(*) FILTER (WHERE n = 1) AS single, count(*) FILTER (WHERE n <> 1) AS multi,
max(n) AS most FROM ({_ISO})""")  # fmt: skip
def a05(features):
    n = isoforms(features)
    return n.agg(F.count("*").alias("genes"), F.round(F.avg("n"), 6).alias("mean_isoforms"), F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") != 1).alias("multi"), F.max("n").alias("most"))


_PRIMARY = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY f_end - f_start DESC, id DESC) AS r FROM fx_feature WHERE type = 'mRNA') WHERE r = 1"""


def longest_transcript(features: DataFrame) -> DataFrame:
    """The longest transcript of each gene, the last one on ties."""
    w = Window.partitionBy("parent").orderBy(F.desc(F.col("f_end") - F.col("f_start")), F.desc("id"))
    return features.where("type = 'mRNA'").withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


@query("W01_longest_per_group", "fx_feature", f"SELECT parent, id, f_end - f_start + 1 AS span FROM ({_PRIMARY})")
def w01(features):
    return longest_transcript(features).select("parent", "id", (F.col("f_end") - F.col("f_start") + 1).alias("span"))


@query("A06_primary_only_counts", "fx_feature", f"""SELECT (SELECT count(*) FROM ({_PRIMARY})) AS transcripts,
(SELECT count(*) FROM fx_feature c WHERE type = 'CDS' AND parent IN (SELECT id FROM ({_PRIMARY}))) AS cds, (SELECT round(avg(f_end - f_start + 1), 6) FROM ({_PRIMARY})) AS mean_span""")  # fmt: skip
def a06(features):
    primary = longest_transcript(features)
    cds = features.where("type = 'CDS'").join(primary.select(F.col("id").alias("parent")), "parent", "left_semi").agg(F.count("*").alias("cds"))
    tx = primary.agg(F.count("*").alias("transcripts"), F.round(F.avg(F.col("f_end") - F.col("f_start") + 1), 6).alias("mean_span"))
    return tx.crossJoin(cds)  # one row each


#: Fixed reference ranges: taxon, least and greatest gene count, mean gene length, exons per gene.
RANGES = [
    ("fungi", 5000, 15000, 100.0, 2000.0, 2.0, 5.0),
    ("ascomycota", 6000, 12000, 300.0, 1500.0, 2.0, 4.0),
    ("basidiomycota", 8000, 20000, 400.0, 2000.0, 3.0, 6.0),
    ("plants", 20000, 50000, 1000.0, 5000.0, 4.0, 8.0),
    ("animals", 15000, 25000, 1000.0, 10000.0, 5.0, 12.0),
    ("mammals", 19000, 23000, 1500.0, 15000.0, 6.0, 15.0),
]


@query("A07_taxon_range_check", "fx_gene", """WITH s AS (SELECT count(*) AS n, avg(g_end - g_start + 1) AS len, avg(n_seg) AS ex FROM fx_gene),
r(taxon, n1, n2, l1, l2, e1, e2) AS (VALUES ('fungi', 5000, 15000, 100.0, 2000.0, 2.0, 5.0), ('ascomycota', 6000, 12000, 300.0, 1500.0, 2.0, 4.0), ('basidiomycota', 8000, 20000, 400.0, 2000.0, 3.0, 6.0),
('plants', 20000, 50000, 1000.0, 5000.0, 4.0, 8.0), ('animals', 15000, 25000, 1000.0, 10000.0, 5.0, 12.0), ('mammals', 19000, 23000, 1500.0, 15000.0, 6.0, 15.0))
SELECT taxon, CASE WHEN n < n1 THEN 'low' WHEN n > n2 THEN 'high' ELSE 'ok' END AS gene_count, CASE WHEN len < l1 THEN 'low' WHEN len > l2 THEN 'high' ELSE 'ok' END AS gene_length,
CASE WHEN ex < e1 THEN 'low' WHEN ex > e2 THEN 'high' ELSE 'ok' END AS exons FROM s, r""")  # fmt: skip
def a07(genes):
    stats = genes.agg(F.count("*").alias("n"), F.avg(F.col("g_end") - F.col("g_start") + 1).alias("len"), F.avg("n_seg").alias("ex"))
    ranges = genes.sparkSession.createDataFrame(RANGES, "taxon string, n1 long, n2 long, l1 double, l2 double, e1 double, e2 double")
    level = lambda v, a, b: F.when(F.col(v) < F.col(a), "low").when(F.col(v) > F.col(b), "high").otherwise("ok")
    return ranges.crossJoin(stats).select("taxon", level("n", "n1", "n2").alias("gene_count"), level("len", "l1", "l2").alias("gene_length"), level("ex", "e1", "e2").alias("exons"))


_ASM = "SELECT seq_id, length(seq) AS n FROM fx_seq"


@query("A09_assembly_summary", "fx_seq", f"""SELECT count(*) FILTER (WHERE n >= 500) AS kept, count(*) FILTER (WHERE n < 500) AS removed, CAST(sum(n) FILTER (WHERE n >= 500) AS BIGINT) AS bases,
max(n) AS longest, min(n) FILTER (WHERE n >= 500) AS shortest_kept FROM ({_ASM})""")  # fmt: skip
def a09(seqs):
    n = seqs.select(F.length("seq").cast("long").alias("n"))
    kept = F.col("n") >= 500
    return n.agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("removed"), F.sum(F.when(kept, F.col("n"))).alias("bases"), F.max("n").alias("longest"), F.min(F.when(kept, F.col("n"))).alias("shortest_kept"))


@query("P01_region_filter", "fx_feature", "SELECT id, type FROM fx_feature WHERE (seqid = 'ctg1') OR (seqid = 'ctg2' AND f_start <= 4000 AND f_end >= 1000) OR (seqid LIKE 'ctg5%' AND seqid <> 'ctg50')")
def p01(features):
    return features.where("seqid = 'ctg1' OR (seqid = 'ctg2' AND f_start <= 4000 AND f_end >= 1000) OR (seqid LIKE 'ctg5%' AND seqid <> 'ctg50')").select("id", "type")


@query("P02_point_in_region", "fx_vcf", "SELECT event_id FROM fx_vcf WHERE chrom = 'ctg1' OR (chrom = 'ctg2' AND pos BETWEEN 1000 AND 4000)")
def p02(variants):
    return variants.where("chrom = 'ctg1' OR (chrom = 'ctg2' AND pos BETWEEN 1000 AND 4000)").select("event_id")


@query("P03_length_filter", "fx_seq", f"SELECT seq_id, n FROM ({_ASM}) WHERE n >= 500")
def p03(seqs):
    return seqs.select("seq_id", F.length("seq").cast("long").alias("n")).where("n >= 500")


@query("P19_ploidy_from_ratio", "fx_seq", f"""SELECT CAST(sum(n) AS BIGINT) AS bases, CASE WHEN sum(n) / 1000000.0 < 1.3 THEN 1 WHEN sum(n) / 1000000.0 < 2.3 THEN 2 WHEN sum(n) / 1000000.0 < 3.3 THEN 3 ELSE 4 END AS ploidy,
CASE WHEN sum(n) / 1000000.0 < 1.3 OR sum(n) / 1000000.0 BETWEEN 1.7 AND 2.3 OR sum(n) / 1000000.0 BETWEEN 2.7 AND 3.3 OR sum(n) / 1000000.0 > 4.5 THEN 'high' ELSE 'low' END AS confidence FROM ({_ASM})""")  # fmt: skip
def p19(seqs):
    total = seqs.agg(F.sum(F.length("seq").cast("long")).alias("bases"))
    r = F.col("bases") / 1e6  # expected haploid size
    sure = (r < 1.3) | r.between(1.7, 2.3) | r.between(2.7, 3.3) | (r > 4.5)
    return total.select("bases", F.when(r < 1.3, 1).when(r < 2.3, 2).when(r < 3.3, 3).otherwise(4).alias("ploidy"), F.when(sure, "high").otherwise("low").alias("confidence"))


@query("T01_sort_contigs", "fx_seq", f"""SELECT seq_id, n, rank() OVER (ORDER BY n DESC, seq_id) AS place FROM ({_ASM}) WHERE n > 0""")
def t01(seqs):
    return numbered(seqs.select("seq_id", F.length("seq").cast("long").alias("n")).where("n > 0"), [F.desc("n"), F.asc("seq_id")], "place")


def ranged(df: DataFrame, order: list) -> DataFrame:
    """Rows dealt to ranges ``_p`` of a global order and written: later looks at them see the same ranges."""
    if "_p" in df.columns:
        raise ValueError("a column is named _p already")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "ranged")


def numbered(df: DataFrame, order: list, out: str) -> DataFrame:
    """Rows numbered from 1 in a global order, without a one-partition window.

    A range shuffle puts the order over ranges; rows are numbered inside each, and the ranges' counts (one row for
    each) give what stands before it.
    """
    rows = ranged(df, order)
    placed = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    # a window over one row for each shuffle partition
    earlier = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = rows.groupBy("_p").agg(F.count("*").alias("_n")).select("_p", earlier.alias("_before"))
    return placed.join(F.broadcast(before), "_p").withColumn(out, (F.col("_before") + F.col("_r")).cast("long")).drop("_p", "_r", "_before")


def padded(number, digits: int = 6):
    """A number with leading zeros, to ``digits`` or as many as it has: ``lpad`` alone would cut longer ones."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0"))


def number_loci(genes: DataFrame, prefix: str = "LOC_", first: int = 1) -> DataFrame:
    """Genes with ``n`` in genome order from ``first``, and the ``locus_tag`` made of it.

    All numbers have as many digits as the last one, six at least.
    """
    named = numbered(genes, [F.asc("seqid"), F.asc("g_start"), F.asc("gid")], "n").withColumn("n", F.col("n") + (first - 1))
    digits = genes.agg(F.greatest(F.lit(6), F.length((F.count("*") + (first - 1)).cast("string"))).alias("_digits"))
    tag = F.concat(F.lit(prefix), F.lpad(F.col("n").cast("string"), F.col("_digits"), F.lit("0")))
    return named.crossJoin(F.broadcast(digits)).withColumn("locus_tag", tag).drop("_digits")  # one row


#: DuckDB's text of a number with as many digits as the greatest one, six at least.
PADDED = "lpad(CAST({0} AS VARCHAR), CAST(greatest(6, length(CAST(max({0}) OVER () AS VARCHAR))) AS INTEGER), '0')"


@query("W05_number_loci", "fx_gene", f"SELECT gid, concat('LOC_', {PADDED.format('n')}) AS locus_tag FROM (SELECT gid, 995000 + row_number() OVER (ORDER BY seqid, g_start, gid) AS n FROM fx_gene)")
def w05(genes):
    """Numbers begin at 995,001, so that they pass a million on small tables too."""
    return number_loci(genes.select("gid", "seqid", "g_start"), first=995_001).select("gid", "locus_tag")


@query("T02_genome_order_sort", "fx_gene", "SELECT gid, row_number() OVER (ORDER BY seqid, g_start, gid) AS place FROM fx_gene")
def t02(genes):
    return numbered(genes.select("gid", "seqid", "g_start"), [F.asc("seqid"), F.asc("g_start"), F.asc("gid")], "place").select("gid", "place")


@query("T03_cap_records", "fx_seq", "SELECT seq_id, (SELECT count(*) > 100 FROM fx_seq) AS capped FROM fx_seq ORDER BY seq_id LIMIT 100")
def t03(seqs):
    size = seqs.agg((F.count("*") > 100).alias("capped"))
    return seqs.select("seq_id").orderBy("seq_id").limit(100).crossJoin(size)  # one row


@query("T05_train_test_split", "fx_gene", """SELECT gid, CASE WHEN n > (SELECT count(*) FROM fx_gene WHERE cds_len >= 300) - 100 THEN 'test' ELSE 'train' END AS part
FROM (SELECT gid, row_number() OVER (ORDER BY seqid, g_start, gid) AS n FROM fx_gene WHERE cds_len >= 300)""")  # fmt: skip
def t05(genes):
    fit = genes.where("cds_len >= 300").select("gid", "seqid", "g_start")
    n = numbered(fit, [F.asc("seqid"), F.asc("g_start"), F.asc("gid")], "n")
    return n.crossJoin(fit.agg(F.count("*").alias("all"))).select("gid", F.when(F.col("n") > F.col("all") - 100, "test").otherwise("train").alias("part"))


@query("U01_union_sources", "fx_gene", "SELECT source, gid FROM fx_gene WHERE source = 'snap' UNION ALL SELECT source, gid FROM fx_gene WHERE source = 'protein'")
def u01(genes):
    parts = [genes.where(F.col("source") == s).select("source", "gid") for s in ("snap", "protein")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query("U02_distinct_training_models", "fx_gene", "SELECT seqid, g_start, g_end, strand, min(gid) AS gid FROM fx_gene WHERE n_seg >= 2 GROUP BY 1, 2, 3, 4")
def u02(genes):
    return genes.where("n_seg >= 2").groupBy("seqid", "g_start", "g_end", "strand").agg(F.min("gid").alias("gid"))


@query("U04_seqids_missing", "fx_feature fx_ctg", "SELECT seqid FROM fx_feature EXCEPT SELECT seqid FROM fx_ctg WHERE seqid NOT LIKE '%7'")
def u04(features, contigs):
    return features.select("seqid").distinct().join(contigs.where("seqid NOT LIKE '%7'"), "seqid", "left_anti")


@query("U07_pending_stages", "fx_runs", """SELECT g.genome, s.stage FROM (SELECT DISTINCT genome FROM fx_runs) g, (SELECT DISTINCT tool AS stage FROM fx_runs) s
WHERE NOT EXISTS (SELECT 1 FROM fx_runs r WHERE r.genome = g.genome AND r.tool = s.stage AND r.metric > 50)""")  # fmt: skip
def u07(runs):
    stages = runs.select(F.col("tool").alias("stage")).distinct()
    done = runs.where("metric > 50").select("genome", F.col("tool").alias("stage")).distinct()
    return runs.select("genome").distinct().crossJoin(stages).join(done, ["genome", "stage"], "left_anti")
