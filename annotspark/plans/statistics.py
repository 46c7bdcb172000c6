"""Tests of counts: allelic imbalance, term enrichment, contrasts of conditions."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.plans.expression import benjamini_hochberg
from annotspark.registry import query

#: Lanczos coefficients (g = 7, nine terms): fixed values.
LANCZOS = [
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
]


def log_gamma(x: Column) -> Column:
    """The logarithm of the gamma function of a positive column, by Lanczos' series."""
    z = x - 1
    series = reduce(lambda t, k: t + F.lit(LANCZOS[k]) / (z + k), range(1, len(LANCZOS)), F.lit(LANCZOS[0]))
    t = z + 7.5
    return 0.5 * math.log(2 * math.pi) + (z + 0.5) * F.log(t) - t + F.log(series)


def _choose(n: Column, k: Column) -> Column:
    return log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)


def _total(first: Column, last: Column, term) -> Column:
    """The sum of ``term(k)`` for whole k from first to last."""
    return F.when(first > last, 0.0).otherwise(F.aggregate(F.sequence(first.cast("int"), last.cast("int")), F.lit(0.0), lambda t, k: t + term(k.cast("double"))))


def _log_factorial_rest(n):
    """What Stirling's formula lacks of log(n!), for an array."""
    small = np.array([0.0] + [math.lgamma(k + 1) - (k + 0.5) * math.log(k) + k - 0.5 * math.log(2 * math.pi) for k in range(1, 17)])
    m = np.maximum(n, 1.0)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - 1 / 1188 / m**2) / m**2) / m**2) / m**2) / m
    whole = (n <= 16) & (n == np.floor(n))
    return np.where(whole, small[np.clip(n, 0, 16).astype(int)], series)


def _deviance(x, m):
    """x log(x / m) + m - x, by a series where x and m are close and the terms would cancel."""
    v = (x - m) / (x + m)
    odd = sum(v ** (2 * j + 1) / (2 * j + 1) for j in range(1, 12))
    return np.where(np.abs(v) < 0.1, (x - m) * v + 2 * x * odd, x * np.log(x / m) + m - x)


def binomial_density(k, n, p):
    """The probability of k successes among n, element by element, without the cancellation of large logarithms."""
    k, n, p = (np.asarray(x, dtype=float) for x in (k, n, p))
    inside = (k > 0) & (k < n)
    a = np.where(inside, k, 0.5)
    b = np.where(inside, n - k, 0.5)
    m = np.where(inside, n, 1.0)
    rest = _log_factorial_rest(m) - _log_factorial_rest(a) - _log_factorial_rest(b) - _deviance(a, m * p) - _deviance(b, m * (1 - p))
    ends = np.where(k == 0, n * np.log1p(-p), np.where(k == n, n * np.log(p), -np.inf))
    return np.where(inside, np.exp(rest) * np.sqrt(m / (2 * math.pi * a * b)), np.exp(ends))


def incomplete_beta(a, b, x):
    """The regularised incomplete beta function of whole a and b by its continued fraction; all elements go on until the last has
    settled, in about the root of a + b steps."""
    other = x >= (a + 1) / (a + b + 2)
    a, b, x = np.where(other, b, a), np.where(other, a, b), np.where(other, 1 - x, x)
    off = lambda v: np.where(np.abs(v) < 1e-300, 1e-300, v)
    c, d = np.ones_like(a), 1 / off(1 - (a + b) * x / (a + 1))
    h = d.copy()
    for m in range(1, int(100 + 20 * math.sqrt(float((a + b).max(initial=0.0))))):
        before = h
        for factor in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            c, d = off(1 + factor / c), 1 / off(1 + factor * d)
            h = h * c * d
        if np.all(np.abs(h - before) <= 1e-15 * np.abs(h)):
            break
    tail = binomial_density(a, a + b, x) * b / (a + b) * h
    return np.where(other, 1 - tail, tail)


def _two_sided(k, n, p):
    """The probabilities of all outcomes at most as likely as k (but for rounding).

    The outcomes beyond the seen one are one tail.  Those on the other side of the likeliest outcome are another, that
    begins where bisection finds the first one as unlikely.
    """
    mode = np.clip(np.floor((n + 1) * p), 0, n)
    bar = binomial_density(k, n, p) * (1 + 1e-7)
    below = k < mode
    near, far = mode.copy(), np.where(below, n + 1, -1.0)  # what is rare lies farther; outcomes outside count as rare
    while np.any(np.abs(far - near) > 1):
        at = np.floor((near + far) / 2)
        rare = binomial_density(np.clip(at, 0, n), n, p) <= bar
        near, far = np.where(rare | (np.abs(far - near) <= 1), near, at), np.where(rare & (np.abs(far - near) > 1), at, far)
    upper = lambda j: np.where(j > n, 0.0, np.where(j <= 0, 1.0, incomplete_beta(np.clip(j, 1, None), np.clip(n - j + 1, 1, None), p)))
    lower = lambda j: np.where(j < 0, 0.0, np.where(j >= n, 1.0, incomplete_beta(np.clip(n - j, 1, None), np.clip(j + 1, 1, None), 1 - p)))
    both = lower(np.where(below, k, far)) + upper(np.where(below, far, k))
    # the likeliest outcome is no rarer than any: all are counted
    return np.where(binomial_density(mode, n, p) <= bar, 1.0, np.minimum(1.0, both))


def binomial_test(hits: Column, total: Column, p: Column) -> Column:
    """Two-sided exact binomial test, batch by batch: its iterations end when they have settled, which expressions can't."""
    @F.pandas_udf("double")
    def test(hits: pd.Series, total: pd.Series, p: pd.Series) -> pd.Series:
        k, n, x = (c.to_numpy(dtype=float) for c in (hits, total, p))
        out = np.full(len(k), np.nan)
        known = ~(np.isnan(k) | np.isnan(n) | np.isnan(x))
        out[known & (x <= 0)] = (k == 0)[known & (x <= 0)]
        out[known & (x >= 1)] = (k == n)[known & (x >= 1)]
        out[known & (n <= 0)] = 1.0
        some = known & (x > 0) & (x < 1) & (n > 0)
        if some.any():
            with np.errstate(all="ignore"):
                out[some] = _two_sided(k[some], n[some], x[some])
        return pd.Series(out).where(known)

    return test(hits, total, p)


def upper_tail(both: Column, row: Column, column: Column, total: Column) -> Column:
    """Upper tail of the hypergeometric distribution: ``both`` or more of ``row`` draws among ``column`` of ``total``."""
    a, b, n = (c.cast("double") for c in (row, column, total))
    term = lambda k: F.exp(_choose(b, k) + _choose(n - b, a - k) - _choose(n, a))
    low = F.greatest(both.cast("double"), a + b - n)
    return F.least(F.lit(1.0), _total(low, F.least(a, b), term))


def allelic_test(haps: DataFrame, least: int = 10, fdr: float = 0.05) -> DataFrame:
    """Per transcript and sample: counts of both haplotypes tested against the sample's share, adjusted per sample.

    Counts are rounded; those of fewer than ``least`` reads are not tested.
    """
    of = lambda h: F.coalesce(F.sum(F.when(F.col("hap") == h, F.col("num_reads"))), F.lit(0.0)).cast("double")
    rows = haps.groupBy("transcript", "sample").agg(of("hap0").alias("hap0"), of("hap1").alias("hap1"))
    share = rows.groupBy("sample").agg(F.sum("hap0").alias("_a"), F.sum(F.col("hap0") + F.col("hap1")).alias("_n"))
    share = share.select("sample", F.when(F.col("_n") == 0, 0.5).otherwise(F.col("_a") / F.col("_n")).alias("null_p"))
    rows = rows.join(share, "sample").withColumn("total", F.col("hap0") + F.col("hap1"))
    tested = F.col("total") >= least
    p = F.when(tested, binomial_test(F.round("hap0").cast("long"), F.round("total").cast("long"), F.col("null_p")))
    rows = rows.withColumn("hap0_frac", F.when(tested, F.col("hap0") / F.col("total"))).withColumn("imbalance", F.col("hap0_frac") - F.col("null_p"))
    rows = rows.withColumn("pvalue", p).withColumn("reason", F.when(tested, "tested").otherwise("below_min_reads"))
    adjusted = benjamini_hochberg(rows.select("transcript", "sample", "pvalue"), "sample", "pvalue", "transcript").select("transcript", "sample", "padj")
    return rows.join(adjusted, ["transcript", "sample"], "left").withColumn("significant", F.coalesce(F.col("padj") < fdr, F.lit(False)))


_ASE = """WITH r AS (SELECT transcript, sample, coalesce(sum(num_reads) FILTER (WHERE hap = 'hap0'), 0)::DOUBLE AS hap0, coalesce(sum(num_reads) FILTER (WHERE hap = 'hap1'), 0)::DOUBLE AS hap1 FROM fx_hap GROUP BY 1, 2),
s AS (SELECT sample, sum(hap0) / sum(hap0 + hap1) AS p FROM r GROUP BY 1), t AS (SELECT r.*, s.p, hap0 + hap1 AS total, round(hap0) AS h, round(hap0 + hap1) AS n FROM r JOIN s USING (sample)),
d AS (SELECT transcript, sample, k, h, exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * ln(p) + (n - k) * ln(1 - p)) AS q FROM (SELECT *, unnest(range(0, CAST(n AS BIGINT) + 1)) AS k FROM t WHERE total >= 10)),
e AS (SELECT transcript, sample, least(1.0, sum(q) FILTER (WHERE q <= seen * 1.0000001)) AS pvalue FROM (SELECT *, max(CASE WHEN k = h THEN q END) OVER (PARTITION BY transcript, sample) AS seen FROM d) GROUP BY 1, 2)
SELECT transcript, sample, total, round(p, 6) AS null_p, round(pvalue, 6) AS pvalue, CASE WHEN total >= 10 THEN 'tested' ELSE 'below_min_reads' END AS reason FROM t LEFT JOIN e USING (transcript, sample)"""


@query("X02_allelic_binomial_test", "fx_hap", _ASE)
def x02(haps):
    return allelic_test(haps).select("transcript", "sample", "total", F.round("null_p", 6).alias("null_p"), F.round("pvalue", 6).alias("pvalue"), "reason")


@query("C09_allele_pipeline", "fx_hap", f"WITH x AS ({_ASE}) SELECT sample, count(*) AS transcripts, count(pvalue) AS tested, round(max(null_p), 6) AS null_p, count(*) FILTER (WHERE pvalue < 0.01) AS uneven FROM x GROUP BY sample")
def c09(haps):
    """Haplotype counts to tested alleles, summed up per sample."""
    found = allelic_test(haps)
    return found.groupBy("sample").agg(F.count("*").alias("transcripts"), F.count("pvalue").alias("tested"), F.round(F.max("null_p"), 6).alias("null_p"), F.count_if(F.round("pvalue", 6) < 0.01).alias("uneven"))


def enrichment(terms: DataFrame, tested: DataFrame, fdr: float = 0.05, least: int = 5) -> DataFrame:
    """Terms (gene, go, ontology) over-represented among genes (gene, padj) below the bound, adjusted per ontology.

    The universe is the genes that are tested and have a term; terms of fewer than ``least`` genes are left out.
    """
    known = terms.where(F.col("go").rlike(r"^GO:\d{7}$")).select("gene", "go", "ontology").distinct()
    genes = tested.where("padj IS NOT NULL").groupBy("gene").agg(F.min("padj").alias("padj"))
    marked = known.join(genes.select("gene", (F.col("padj") < fdr).alias("hit")), "gene")
    universe = marked.select("gene", "hit").distinct().agg(F.count("*").alias("total"), F.count_if("hit").alias("hits"))
    per = marked.groupBy("ontology", "go").agg(F.count("*").alias("genes"), F.count_if("hit").alias("both")).where(F.col("genes") >= least)
    rows = per.crossJoin(F.broadcast(universe)).withColumn("pvalue", upper_tail(F.col("both"), F.col("hits"), F.col("genes"), F.col("total")))  # one row
    return benjamini_hochberg(rows, "ontology", "pvalue", "go")


_GO = """WITH u AS (SELECT gene, min(padj) < 0.05 AS hit FROM fx_go GROUP BY gene), m AS (SELECT DISTINCT f.gene, go, ontology, hit FROM fx_go f JOIN u USING (gene)), n AS (SELECT count(*) AS total, count(*) FILTER (WHERE hit) AS hits FROM u),
t AS (SELECT ontology, go, count(*) AS genes, count(*) FILTER (WHERE hit) AS shared FROM m GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT ontology, go, genes, shared, round(least(1.0, coalesce(sum(exp(lgamma(genes + 1) - lgamma(k + 1) - lgamma(genes - k + 1) + lgamma(total - genes + 1) - lgamma(hits - k + 1) - lgamma(total - genes - hits + k + 1)
- lgamma(total + 1) + lgamma(hits + 1) + lgamma(total - hits + 1))), 0)), 6) AS pvalue FROM (SELECT *, unnest(range(greatest(shared, hits + genes - total), least(hits, genes) + 1)) AS k FROM t, n) GROUP BY 1, 2, 3, 4"""


@query("X03_go_enrichment", "fx_go", _GO)
def x03(go):
    found = enrichment(go.select("gene", "go", "ontology"), go.select("gene", "padj"))
    return found.select("ontology", "go", "genes", F.col("both").alias("shared"), F.round("pvalue", 6).alias("pvalue"))


def size_factors(counts: DataFrame) -> DataFrame:
    """(sample, factor): medians of ratios to the transcripts' geometric means, over transcripts counted in every sample."""
    samples = counts.agg(F.count_distinct("sample").alias("_s"))
    logs = counts.where("num_reads > 0").groupBy("transcript").agg(F.avg(F.log("num_reads")).alias("mean"), F.count("*").alias("_n"))
    logs = logs.crossJoin(F.broadcast(samples)).where("_n = _s").select("transcript", "mean")  # one row
    ratio = counts.join(logs, "transcript").select("sample", (F.log("num_reads") - F.col("mean")).alias("ratio"))
    found = ratio.groupBy("sample").agg(F.exp(F.percentile("ratio", 0.5)).alias("factor"))
    return counts.select("sample").distinct().join(found, "sample", "left").select("sample", F.coalesce("factor", F.lit(1.0)).alias("factor"))


def normal_tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution (Abramowitz and Stegun 7.1.26, within 1.5e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return poly * F.exp(-x * x)


def contrast(counts: DataFrame, treated: str = "treated", control: str = "control", fdr: float = 0.05, fold: float = 1.0) -> DataFrame:
    """Per transcript: mean, log2 fold change, its error, p and adjusted p between two conditions.

    Counts are scaled by :func:`size_factors`; the error is that of a negative-binomial mean with a dispersion from the
    moments of each condition.  This is an estimator of its own: no shrinkage, and not equal to that of other programs.
    """
    scaled = counts.join(F.broadcast(size_factors(counts)), "sample").withColumn("x", F.col("num_reads") / F.col("factor"))  # a row for each sample
    by = lambda f, c: f(F.when(F.col("condition") == c, F.col("x")))
    one = scaled.groupBy("transcript").agg(F.avg("x").alias("base_mean"), *[by(f, c).alias(f"{n}_{s}") for s, c in (("t", treated), ("c", control)) for n, f in (("m", F.avg), ("v", F.var_samp), ("n", F.count))])
    one = one.where("n_t > 0 AND n_c > 0")
    spread = lambda s: F.greatest(F.coalesce(F.col(f"v_{s}"), F.col(f"m_{s}")), F.col(f"m_{s}")) / F.col(f"n_{s}") / ((F.col(f"m_{s}") + 0.5) * (F.col(f"m_{s}") + 0.5))
    lfc = F.log2((F.col("m_t") + 0.5) / (F.col("m_c") + 0.5))
    error = F.sqrt(spread("t") + spread("c")) / math.log(2)
    rows = one.select("transcript", "base_mean", lfc.alias("lfc"), error.alias("error")).withColumn("pvalue", F.when(F.col("error") > 0, normal_tail(F.col("lfc") / F.col("error"))))
    found = benjamini_hochberg(rows.withColumn("_g", F.lit(0)), "_g", "pvalue", "transcript").select("transcript", "padj")
    return rows.join(found, "transcript", "left").withColumn("significant", F.coalesce((F.col("padj") < fdr) & (F.abs("lfc") >= fold), F.lit(False)))


_SF = """(WITH l AS (SELECT transcript, avg(ln(num_reads)) AS mean FROM fx_quant WHERE num_reads > 0 GROUP BY transcript HAVING count(*) = (SELECT count(DISTINCT sample) FROM fx_quant))
SELECT s.sample, coalesce(f.factor, 1.0) AS factor FROM (SELECT DISTINCT sample FROM fx_quant) s LEFT JOIN (SELECT sample, exp(quantile_cont(ln(num_reads) - mean, 0.5)) AS factor FROM fx_quant JOIN l USING (transcript) GROUP BY sample) f ON f.sample = s.sample)"""


@query("X04_de_contrast", "fx_quant", f"""WITH x AS (SELECT transcript, condition, num_reads / factor AS x FROM fx_quant JOIN {_SF} USING (sample)),
m AS (SELECT transcript, avg(x) AS base_mean, avg(x) FILTER (WHERE condition = 'treated') AS mt, avg(x) FILTER (WHERE condition = 'control') AS mc FROM x GROUP BY transcript HAVING count(*) FILTER (WHERE condition = 'treated') > 0 AND count(*) FILTER (WHERE condition = 'control') > 0)
SELECT transcript, round(base_mean, 5) AS base_mean, round(log2((mt + 0.5) / (mc + 0.5)), 5) AS lfc FROM m""")  # fmt: skip
def x04(quant):
    return contrast(quant).select("transcript", F.round("base_mean", 5).alias("base_mean"), F.round("lfc", 5).alias("lfc"))
