"""Expression, haplotypes, orthogroups, run metrics."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.plans.features import ranged
from annotspark.registry import query

SAMPLES = [f"s{i}" for i in range(6)]
_PIVOT = ", ".join(f"coalesce(sum({{}}) FILTER (WHERE sample = '{s}'), 0) AS {s}" for s in SAMPLES)


def matrix(quant: DataFrame, row: str, column: str, value: str, names: list[str]) -> DataFrame:
    """Wide matrix with the named columns in their order; missing is 0."""
    return quant.groupBy(row).pivot(column, names).agg(F.sum(value)).fillna(0.0)


@query("A15_expression_matrix", "fx_quant", f"SELECT transcript, {_PIVOT.format(*['num_reads'] * 6)} FROM fx_quant GROUP BY transcript")
def a15(quant):
    return matrix(quant, "transcript", "sample", "num_reads", SAMPLES)


_HAPS = [f"s{i}.hap{h}" for i in range(3) for h in range(2)]


@query("A16_haplotype_matrix", "fx_hap", "SELECT transcript, " + ", ".join(f"coalesce(sum(num_reads) FILTER (WHERE sample = '{c[:2]}' AND hap = '{c[3:]}'), 0) AS {c.replace('.', '_')}" for c in _HAPS) + " FROM fx_hap GROUP BY transcript")
def a16(haps):
    wide = matrix(haps.withColumn("c", F.concat_ws(".", "sample", "hap")), "transcript", "c", "num_reads", _HAPS)
    return wide.toDF("transcript", *[c.replace(".", "_") for c in _HAPS])


_BOTH = "SELECT transcript, sample, coalesce(sum(num_reads) FILTER (WHERE hap = 'hap0'), 0) AS c0, coalesce(sum(num_reads) FILTER (WHERE hap = 'hap1'), 0) AS c1 FROM fx_hap GROUP BY 1, 2"


def allele_counts(haps: DataFrame) -> DataFrame:
    side = lambda h: F.coalesce(F.sum(F.when(F.col("hap") == h, F.col("num_reads"))), F.lit(0.0))
    return haps.groupBy("transcript", "sample").agg(side("hap0").alias("c0"), side("hap1").alias("c1"))


@query("A17_allele_summary", "fx_hap", f"SELECT transcript, round(max(abs(c0 - c1) / (c0 + c1 + 1)), 6) AS imbalance, sum(c0) + sum(c1) > 0 AS informative FROM ({_BOTH}) GROUP BY transcript")
def a17(haps):
    c0, c1 = F.col("c0"), F.col("c1")
    return allele_counts(haps).groupBy("transcript").agg(F.round(F.max(F.abs(c0 - c1) / (c0 + c1 + 1)), 6).alias("imbalance"), (F.sum("c0") + F.sum("c1") > 0).alias("informative"))


@query("A18_max_tpm_filter", "fx_quant", "SELECT transcript, max(tpm) AS max_tpm FROM fx_quant GROUP BY transcript HAVING max(tpm) >= 15")
def a18(quant):
    return quant.groupBy("transcript").agg(F.max("tpm").alias("max_tpm")).where("max_tpm >= 15")


@query("A19_reads_total", "fx_hap", "SELECT sample, CAST(round(sum(num_reads)) AS BIGINT) AS reads, max(n) - min(n) > 0.05 * sum(num_reads) AS uneven FROM (SELECT sample, hap, num_reads, sum(num_reads) OVER (PARTITION BY sample, hap) AS n FROM fx_hap) GROUP BY sample")
def a19(haps):
    per = haps.groupBy("sample", "hap").agg(F.sum("num_reads").alias("n"))
    return per.groupBy("sample").agg(F.round(F.sum("n")).cast("long").alias("reads"), (F.max("n") - F.min("n") > 0.05 * F.sum("n")).alias("uneven"))


@query("X01_low_count_prefilter", "fx_quant", "SELECT transcript, count(*) FILTER (WHERE CAST(floor(num_reads) AS BIGINT) >= 10) AS samples FROM fx_quant GROUP BY transcript HAVING count(*) FILTER (WHERE CAST(floor(num_reads) AS BIGINT) >= 10) >= 3")
def x01(quant):
    return quant.groupBy("transcript").agg(F.count_if(F.floor("num_reads") >= 10).alias("samples")).where("samples >= 3")


def benjamini_hochberg(df: DataFrame, group: str, p: str, tie: str, out: str = "padj") -> DataFrame:
    """Adjusted p-values per group: the least of p * n / rank over equal or larger p-values, at most 1; null p-values are left out.

    A group may hold most of the rows, so it is dealt to ranges of the order by p: ranks go on from the ranges before,
    minima from those behind.  What is gathered of the ranges are a few numbers for each group and range.
    """
    rows = ranged(df.where(F.col(p).isNotNull()), [F.asc(group), F.asc(p), F.asc(tie)])
    here = Window.partitionBy("_p", group)
    parts = Window.partitionBy(group).orderBy("_p")
    sizes = rows.groupBy(group, "_p").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(group, "_p", before.alias("_before"), F.sum("_n").over(Window.partitionBy(group)).alias("_all"))
    rank = F.col("_before") + F.row_number().over(here.orderBy(p, tie))
    scaled = rows.join(sizes, [group, "_p"]).withColumn("_q", F.col(p) * F.col("_all") / rank)
    least = scaled.groupBy(group, "_p").agg(F.min("_q").alias("_m"))
    behind = least.select(group, "_p", F.min("_m").over(parts.rowsBetween(1, Window.unboundedFollowing)).alias("_behind"))
    down = here.orderBy(F.desc(p), F.desc(tie)).rowsBetween(Window.unboundedPreceding, 0)
    done = scaled.withColumn("_q", F.min("_q").over(down)).join(behind, [group, "_p"])
    return done.withColumn(out, F.least(F.lit(1.0), "_q", F.coalesce("_behind", F.lit(1.0)))).drop("_q", "_p", "_before", "_all", "_behind")


@query("W08_bh_adjust", "fx_go", """SELECT gene, ontology, round(least(1.0, min(q) OVER (PARTITION BY ontology ORDER BY padj DESC, gene DESC ROWS UNBOUNDED PRECEDING)), 6) AS adjusted FROM (
SELECT *, padj * count(*) OVER (PARTITION BY ontology) / row_number() OVER (PARTITION BY ontology ORDER BY padj, gene) AS q FROM fx_go)""")  # fmt: skip
def w08(go):
    return benjamini_hochberg(go, "ontology", "padj", "gene", "adjusted").select("gene", "ontology", F.round("adjusted", 6).alias("adjusted"))


@query("T04_top_k_terms", "fx_go", "SELECT ontology, gene, go, padj FROM (SELECT *, row_number() OVER (PARTITION BY ontology ORDER BY padj, gene) AS r FROM fx_go) WHERE r <= 10")
def t04(go):
    w = Window.partitionBy("ontology").orderBy("padj", "gene")
    return go.withColumn("r", F.row_number().over(w)).where("r <= 10").select("ontology", "gene", "go", "padj")


_OG = "SELECT og, count(DISTINCT genome) AS n, count(*) AS genes FROM fx_ortho GROUP BY og"
_KIND = "CASE WHEN n = 5 THEN 'core' WHEN n >= 4 THEN 'soft_core' WHEN n = 1 THEN 'singleton' WHEN n <= 1 THEN 'cloud' ELSE 'shell' END"


def orthogroup_kinds(ortho: DataFrame, genomes: int = 5, soft: float = 0.95, cloud: float = 0.15) -> DataFrame:
    """(og, n genomes, genes, kind)."""
    n = F.col("n")
    kind = F.when(n == genomes, "core").when(n >= math.ceil(genomes * soft), "soft_core").when(n == 1, "singleton").when(n <= math.ceil(genomes * cloud), "cloud").otherwise("shell")
    return ortho.groupBy("og").agg(F.count_distinct("genome").alias("n"), F.count("*").alias("genes")).withColumn("kind", kind)


@query("A20_pangenome_summary", "fx_ortho", f"SELECT kind, count(*) AS groups, count(*) FILTER (WHERE n = 5 AND genes = 5) AS single_copy_core FROM (SELECT *, {_KIND} AS kind FROM ({_OG})) GROUP BY kind")
def a20(ortho):
    return orthogroup_kinds(ortho, soft=0.8).groupBy("kind").agg(F.count("*").alias("groups"), F.count_if((F.col("n") == 5) & (F.col("genes") == 5)).alias("single_copy_core"))


@query("A21_ortholog_table", "fx_ortho", "SELECT og, " + ", ".join(f"coalesce(string_agg(gene, ',' ORDER BY gene) FILTER (WHERE genome = 'G{i}'), '-') AS G{i}" for i in range(5)) + """, count(DISTINCT genome) AS n_genomes,
CASE WHEN count(DISTINCT genome) = 5 THEN CASE WHEN count(*) = 5 THEN 'core_single_copy' ELSE 'core' END WHEN count(DISTINCT genome) = 1 THEN 'singleton' ELSE 'accessory' END AS category FROM fx_ortho GROUP BY og""")  # fmt: skip
def a21(ortho, genomes: int = 5):
    names = [f"G{i}" for i in range(genomes)]
    wide = ortho.groupBy("og").pivot("genome", names).agg(F.array_join(F.sort_array(F.collect_list("gene")), ","))
    size = ortho.groupBy("og").agg(F.count_distinct("genome").alias("n_genomes"), F.count("*").alias("_genes"))
    n = F.col("n_genomes")
    category = F.when(n == genomes, F.when(F.col("_genes") == genomes, "core_single_copy").otherwise("core")).when(n == 1, "singleton").otherwise("accessory")
    return wide.join(size, "og").select("og", *[F.when(F.coalesce(F.col(g), F.lit("")) == "", "-").otherwise(F.col(g)).alias(g) for g in names], "n_genomes", category.alias("category"))


@query("A22_per_genome_pan_stats", "fx_ortho", f"""SELECT genome, count(DISTINCT gene) AS proteins, count(DISTINCT o.og) AS groups, round(100.0 * count(*) FILTER (WHERE n = 5) / count(*), 6) AS core_percent,
round(100.0 * count(*) FILTER (WHERE n = 1) / count(*), 6) AS singleton_percent FROM fx_ortho o JOIN ({_OG}) g ON g.og = o.og GROUP BY genome""")  # fmt: skip
def a22(ortho):
    rows = ortho.join(orthogroup_kinds(ortho).select("og", "n"), "og")
    share = lambda c: F.round(100.0 * F.count_if(c) / F.count("*"), 6)
    return rows.groupBy("genome").agg(F.count_distinct("gene").alias("proteins"), F.count_distinct("og").alias("groups"), share(F.col("n") == 5).alias("core_percent"), share(F.col("n") == 1).alias("singleton_percent"))


@query("A23_genome_tier_cap", "fx_ortho", "SELECT max(n) AS proteins, CASE WHEN max(n) <= 15000 THEN 5 WHEN max(n) <= 30000 THEN 3 ELSE 2 END AS allowed FROM (SELECT genome, count(DISTINCT gene) AS n FROM fx_ortho GROUP BY genome)")
def a23(ortho):
    n = ortho.groupBy("genome").agg(F.count_distinct("gene").alias("n")).agg(F.max("n").alias("proteins"))
    return n.withColumn("allowed", F.when(F.col("proteins") <= 15000, 5).when(F.col("proteins") <= 30000, 3).otherwise(2))


@query("S22_read_orthogroups", "fx_ortho", "SELECT og, genome, gene FROM fx_ortho")
def s22(ortho):
    return long_orthogroups(a21(ortho).drop("n_genomes", "category"), "og")


def long_orthogroups(wide: DataFrame, key: str) -> DataFrame:
    """Wide group tables, one column of comma-joined genes per genome, as rows (og, genome, gene)."""
    rows = wide.unpivot(key, [c for c in wide.columns if c != key], "genome", "genes")
    return rows.select(key, "genome", F.explode(F.split("genes", ",")).alias("gene")).select(key, "genome", F.trim("gene").alias("gene")).where("gene NOT IN ('', '-')")


@query("A24_run_summary", "fx_runs", "SELECT tool, count(*) FILTER (WHERE metric > 0) AS runs, round(avg(metric) FILTER (WHERE metric > 0), 4) AS mean, round(stddev_samp(metric) FILTER (WHERE metric > 0), 4) AS sd FROM fx_runs GROUP BY tool")
def a24(runs):
    v = F.when(F.col("metric") > 0, F.col("metric"))
    return runs.groupBy("tool").agg(F.count(v).alias("runs"), F.round(F.avg(v), 4).alias("mean"), F.round(F.stddev_samp(v), 4).alias("sd"))


@query("A25_replicate_rollup", "fx_runs", "SELECT genome, tool, round(avg(metric), 6) AS mean, round(median(metric), 6) AS middle, count(*) AS n FROM fx_runs GROUP BY genome, tool")
def a25(runs):
    return runs.groupBy("genome", "tool").agg(F.round(F.avg("metric"), 6).alias("mean"), F.round(F.percentile("metric", F.lit(0.5)), 6).alias("middle"), F.count("*").alias("n"))


_TOOLS = "SELECT genome, avg(metric) FILTER (WHERE tool = 'click') AS a, avg(metric) FILTER (WHERE tool = 'view') AS b FROM fx_runs GROUP BY genome"


@query("A26_win_tally", "fx_runs", f"SELECT count(*) FILTER (WHERE a - b > 1e-9) AS wins, count(*) FILTER (WHERE b - a > 1e-9) AS losses, count(*) FILTER (WHERE abs(a - b) <= 1e-9) AS ties FROM ({_TOOLS})")
def a26(runs):
    mean = lambda t: F.avg(F.when(F.col("tool") == t, F.col("metric")))
    d = runs.groupBy("genome").agg((mean("click") - mean("view")).alias("d"))
    return d.agg(F.count_if(F.col("d") > 1e-9).alias("wins"), F.count_if(F.col("d") < -1e-9).alias("losses"), F.count_if(F.abs("d") <= 1e-9).alias("ties"))


@query("A27_source_timings", "fx_runs", "SELECT tool, round(sum(metric), 4) AS seconds, count(*) AS n FROM fx_runs GROUP BY tool")
def a27(runs):
    return runs.groupBy("tool").agg(F.round(F.sum("metric"), 4).alias("seconds"), F.count("*").alias("n"))


@query("B01_batch_summary", "fx_runs", "SELECT count(*) FILTER (WHERE m >= 90) AS done, count(*) FILTER (WHERE m < 30) AS failed, count(*) FILTER (WHERE m >= 30 AND m < 90) AS pending FROM (SELECT genome, max(metric) AS m FROM fx_runs GROUP BY genome)")
def b01(runs):
    m = F.col("m")
    return runs.groupBy("genome").agg(F.max("metric").alias("m")).agg(F.count_if(m >= 90).alias("done"), F.count_if(m < 30).alias("failed"), F.count_if((m >= 30) & (m < 90)).alias("pending"))


@query("B02_state_transitions", "fx_runs", "SELECT genome, string_agg(DISTINCT tool, ',' ORDER BY tool) AS completed, max_by(tool, pos) AS current, count(*) AS events FROM fx_runs GROUP BY genome")
def b02(runs):
    return runs.groupBy("genome").agg(F.array_join(F.sort_array(F.collect_set("tool")), ",").alias("completed"), F.max_by("tool", "pos").alias("current"), F.count("*").alias("events"))


def student_tail(t: Column, df: Column) -> Column:
    """Two-sided tail of Student's t for whole degrees of freedom, by the finite series in the angle whose tangent is t / sqrt(df)."""
    angle = F.atan(F.abs(t) / F.sqrt(df.cast("double")))
    square = F.cos(angle) * F.cos(angle)
    odd = df % 2 == 1
    # each term is the one before it times (k - 1) / k or so, k going up in twos
    steps = F.filter(F.sequence(F.lit(1), F.greatest(df.cast("int"), F.lit(1))), lambda k: (k <= df - 2) & F.when(odd, k % 2 == 0).otherwise(k % 2 == 1))
    first = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    grown = F.aggregate(steps, first, lambda a, k: F.struct((a["term"] * square * k / (k + 1)).alias("term"), (a["sum"] + a["term"] * square * k / (k + 1)).alias("sum")))["sum"]
    inside = F.when(df == 1, 2 * angle / math.pi).when(odd, 2 / math.pi * (angle + F.sin(angle) * F.cos(angle) * grown)).otherwise(F.sin(angle) * grown)
    return F.greatest(F.lit(0.0), 1 - inside)


def paired(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, means, mean difference, paired t, its two-sided p and Cohen's d; pairs count where both are above 0, and two are needed."""
    rows = pairs.where((F.col(a) > 0) & (F.col(b) > 0)).withColumn("_x", F.col(a) - F.col(b))
    one = rows.agg(F.count("*").alias("n"), F.avg(a).alias("mean_a"), F.avg(b).alias("mean_b"), F.avg("_x").alias("difference"), F.stddev_samp("_x").alias("_s"))
    fine = (F.col("n") >= 2) & (F.col("_s") > 0)
    one = one.withColumn("d", F.when(fine, F.col("difference") / F.col("_s"))).withColumn("t", F.when(fine, F.col("d") * F.sqrt("n")))
    return one.withColumn("p", F.when(fine, student_tail(F.col("t"), F.col("n") - 1))).drop("_s")


@query("X05_paired_comparison", "fx_runs", """WITH p AS (SELECT genome, rep, avg(metric) FILTER (WHERE tool = 'click') AS a, avg(metric) FILTER (WHERE tool = 'view') AS b FROM fx_runs GROUP BY genome, rep)
SELECT count(*) AS n, round(avg(a), 6) AS mean_a, round(avg(b), 6) AS mean_b, round(avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))), 6) AS t, round(avg(a - b) / stddev_samp(a - b), 6) AS d FROM p WHERE a > 0 AND b > 0""")  # fmt: skip
def x05(runs):
    mean = lambda t: F.avg(F.when(F.col("tool") == t, F.col("metric")))
    found = paired(runs.groupBy("genome", "rep").agg(mean("click").alias("a"), mean("view").alias("b")), "a", "b")
    return found.select("n", *[F.round(c, 6).alias(c) for c in ("mean_a", "mean_b", "t", "d")])
