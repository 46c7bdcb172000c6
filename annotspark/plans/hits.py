"""Search hits: ranking, filters, names, merging into annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.registry import query
from annotspark.sources import carried


def best(hits: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row per key in the given order; the order ends in a tie-break."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return hits.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


EV = ["evalue", "pos", "partkey"]


@query("W02_best_hit_per_query", "fx_hits", "SELECT query, target, evalue FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY evalue, pos, partkey) AS r FROM fx_hits) WHERE r = 1")
def w02(hits):
    return best(hits, ["query"], *EV).select("query", "target", "evalue")


@query("W03_best_per_query_domain", "fx_hits", "SELECT query, source, target, evalue FROM (SELECT *, row_number() OVER (PARTITION BY query, source ORDER BY evalue, pos, partkey) AS r FROM fx_hits) WHERE r = 1")
def w03(hits):
    return best(hits, ["query", "source"], *EV).select("query", "source", "target", "evalue")


_CUT = """SELECT query, regexp_replace(target, '\\.hmm$', '') AS family, evalue, pos, partkey FROM fx_hits
WHERE CASE WHEN hmm_to - hmm_from > 80 THEN evalue <= 0.005 ELSE evalue <= 0.002 END AND (hmm_to - hmm_from) / CAST(dom_len AS DOUBLE) > 0.35"""


@query("W04_dbcan_cutoff_best", "fx_hits", f"SELECT query, family, evalue FROM (SELECT *, row_number() OVER (PARTITION BY query, family ORDER BY evalue, pos, partkey) AS r FROM ({_CUT})) WHERE r = 1")
def w04(hits, long_e: float = 0.005, short_e: float = 0.002, coverage: float = 0.35):
    span = F.col("hmm_to") - F.col("hmm_from")
    good = F.col("evalue") <= F.when(span > 80, long_e).otherwise(short_e)
    kept = hits.where(good & (span / F.col("dom_len") > coverage)).withColumn("family", F.regexp_replace("target", r"\.hmm$", ""))
    return best(kept, ["query", "family"], *EV).select("query", "family", "evalue")


@query("P10_clean_description", "fx_hits", "SELECT DISTINCT target, concat('kinase ', target) AS product FROM fx_hits")
def p10(hits):
    raw = F.concat(F.lit("sp|Q1|T_YEAST kinase "), "target", F.lit(" OS=Saccharomyces"))
    return hits.select("target", clean_description(raw).alias("product")).distinct()


def clean_description(raw: Column) -> Column:
    """Cut at `` OS=``, keep what follows the last bar, drop a leading entry name; empty becomes a hypothetical protein."""
    text = F.regexp_replace(F.substring_index(F.substring_index(raw, " OS=", 1), "|", -1), "^[A-Z0-9]+_[A-Z0-9]+ ", "")
    return F.when(F.trim(text) == "", "hypothetical protein").otherwise(F.trim(text))


@query("P11_accession_normalise", "fx_hits", "SELECT DISTINCT target, substr(target, 2) AS accession FROM fx_hits")
def p11(hits):
    name = F.concat(F.lit("tr|"), F.substring("target", 2, 20), F.lit("|X"))
    return hits.select("target", F.get(F.split(name, r"\|"), F.lit(1)).alias("accession")).distinct()


#: Fixed class prefixes of carbohydrate-active enzymes.
CLASSES = ["GH", "GT", "PL", "CE", "AA", "CBM"]


def enzyme_class(family: Column) -> Column:
    out = F.when(family.rlike("^CBM"), "CBM")
    for c in CLASSES[:-1]:
        out = out.when(family.startswith(c), c)
    return out.otherwise("Other")


_FAM = "substr('GHGTPLCEAAXX', CAST(1 + 2 * (partkey % 6) AS BIGINT), 2) || CAST(partkey % 40 AS VARCHAR)"


def _families(hits: DataFrame) -> DataFrame:
    name = F.concat(F.substring(F.lit("GHGTPLCEAAXX"), (1 + 2 * (F.col("partkey") % 6)).cast("int"), F.lit(2)), (F.col("partkey") % 40).cast("string"))
    return hits.withColumn("family", name)


@query("P13_family_class", "fx_hits", f"SELECT DISTINCT family, CASE WHEN left(family, 2) IN ('GH', 'GT', 'PL', 'CE', 'AA') THEN left(family, 2) ELSE 'Other' END AS class FROM (SELECT {_FAM} AS family FROM fx_hits)")
def p13(hits):
    return _families(hits).select("family", enzyme_class(F.col("family")).alias("class")).distinct()


@query("A11_category_breakdown", "fx_hits", f"SELECT class, count(*) AS n, count(DISTINCT query) AS queries FROM (SELECT query, CASE WHEN left(f, 2) IN ('GH', 'GT', 'PL', 'CE', 'AA') THEN left(f, 2) ELSE 'Other' END AS class FROM (SELECT query, {_FAM} AS f FROM fx_hits)) GROUP BY class")
def a11(hits):
    return _families(hits).groupBy(enzyme_class(F.col("family")).alias("class")).agg(F.count("*").alias("n"), F.count_distinct("query").alias("queries"))


@query("A12_peptidase_summary", "fx_hits", """SELECT family, count(*) FILTER (WHERE source <> 'family') AS peptidases, count(*) FILTER (WHERE source = 'family') AS inhibitors FROM
(SELECT source, CAST(partkey % 40 AS BIGINT) AS family FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY evalue, pos, partkey) AS r FROM fx_hits) WHERE r = 1) GROUP BY family""")  # fmt: skip
def a12(hits):
    top = best(hits, ["query"], *EV).withColumn("family", (F.col("partkey") % 40).cast("long"))
    return top.groupBy("family").agg(F.count_if(F.col("source") != "family").alias("peptidases"), F.count_if(F.col("source") == "family").alias("inhibitors"))


@query("P22_informative_product", "fx_hits", """SELECT source, count(*) AS n, count(*) FILTER (WHERE NOT regexp_matches(lower(product), '^(hypothetical protein|unknown|uncharacterized|predicted protein)\\s*$')) AS informative
FROM (SELECT source, CASE partkey % 3 WHEN 0 THEN 'Hypothetical protein ' WHEN 1 THEN 'unknown' ELSE 'kinase' END AS product FROM fx_hits) GROUP BY source""")  # fmt: skip
def p22(hits):
    product = F.when(F.col("partkey") % 3 == 0, "Hypothetical protein ").when(F.col("partkey") % 3 == 1, "unknown").otherwise("kinase")
    named = hits.select("source", product.alias("product"))
    bare = F.col("product").rlike(r"(?i)^(hypothetical protein|unknown|uncharacterized|predicted protein)\s*$")
    return named.groupBy("source").agg(F.count("*").alias("n"), F.count_if(~bare).alias("informative"))


_TOP = "SELECT query, target, identity, evalue FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY evalue, pos, partkey) AS r FROM fx_hits WHERE source = '{}') WHERE r = 1"
_MERGED = f"""SELECT concat('LT', CAST(g.gid AS VARCHAR)) AS locus, coalesce(h.target, d.target, f.target, 'hypothetical protein') AS product, h.identity, h.evalue
FROM fx_gene g LEFT JOIN ({_TOP.format("homology")}) h ON h.query = concat('LT', CAST(g.gid AS VARCHAR)) LEFT JOIN ({_TOP.format("domain")}) d ON d.query = concat('LT', CAST(g.gid AS VARCHAR))
LEFT JOIN ({_TOP.format("family")}) f ON f.query = concat('LT', CAST(g.gid AS VARCHAR))"""


def merge_annotations(genes: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per locus: product by source priority, accession fields from homology; hits of other genes are ignored.

    Each source is reduced to its best hit per query first, so the joins meet one row per locus on either side.
    """
    out = genes.select(F.concat(F.lit("LT"), F.col("gid").cast("string")).alias("locus"))
    names = []
    for s in ("homology", "domain", "family"):
        top = best(hits.where(F.col("source") == s), ["query"], *EV)
        out = out.join(top.select(F.col("query").alias("locus"), *[F.col(c).alias(f"{s}_{c}") for c in ("target", "identity", "evalue")]), "locus", "left")
        names.append(F.col(f"{s}_target"))
    product = F.coalesce(*names, F.lit("hypothetical protein"))
    return out.select("locus", product.alias("product"), F.col("homology_identity").alias("identity"), F.col("homology_evalue").alias("evalue"))


@query("J08_merge_annotations", "fx_gene fx_hits", f"SELECT locus, product, round(identity, 6) AS identity, evalue FROM ({_MERGED})")
def j08(genes, hits):
    return merge_annotations(genes, hits).withColumn("identity", F.round("identity", 6))


@query("A10_annotation_coverage", "fx_gene fx_hits", f"""SELECT count(*) AS genes, round(avg(CASE WHEN product <> 'hypothetical protein' THEN 1.0 ELSE 0.0 END), 6) AS with_product,
round(avg(CASE WHEN identity IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS with_homology, round(avg(length(product)), 6) AS mean_length FROM ({_MERGED})""")  # fmt: skip
def a10(genes, hits):
    share = lambda c: F.round(F.avg(c.cast("double")), 6)
    return merge_annotations(genes, hits).agg(F.count("*").alias("genes"), share(F.col("product") != "hypothetical protein").alias("with_product"), share(F.col("identity").isNotNull()).alias("with_homology"), F.round(F.avg(F.length("product")), 6).alias("mean_length"))


@query("J09_go_from_accession", "fx_gene fx_hits fx_go", """SELECT locus, string_agg(DISTINCT go, '|' ORDER BY go) AS terms FROM (SELECT concat('LT', CAST(g.gid AS VARCHAR)) AS locus, t.go FROM fx_gene g
JOIN fx_hits h ON h.query = concat('LT', CAST(g.gid AS VARCHAR)) JOIN fx_go t ON t.gene = 'tx' || substr(h.target, 2)) GROUP BY locus""")  # fmt: skip
def j09(genes, hits, go):
    locus = genes.select(F.concat(F.lit("LT"), F.col("gid").cast("string")).alias("query"))
    named = hits.join(locus, "query", "left_semi").select("query", F.concat(F.lit("tx"), F.expr("substr(target, 2)")).alias("gene")).distinct()
    return named.join(go, "gene").groupBy(F.col("query").alias("locus")).agg(F.array_join(F.sort_array(F.collect_set("go")), "|").alias("terms"))


@query("J12_resolve_names", "fx_hits", "SELECT query, min_by(target, CASE source WHEN 'homology' THEN 1 WHEN 'domain' THEN 2 ELSE 3 END * 10000000000 + partkey) AS name FROM fx_hits GROUP BY query")
def j12(hits):
    rank = F.when(F.col("source") == "homology", 1).when(F.col("source") == "domain", 2).otherwise(3)
    return hits.groupBy("query").agg(F.min_by("target", F.struct(rank, "partkey")).alias("name"))


@query("J13_subset_by_hit_ids", "fx_gene fx_hits", "SELECT gid FROM fx_gene g WHERE EXISTS (SELECT 1 FROM fx_hits h WHERE h.query = concat('LT', CAST(g.gid AS VARCHAR)) AND h.identity >= 70)")
def j13(genes, hits):
    named = genes.withColumn("query", F.concat(F.lit("LT"), F.col("gid").cast("string")))
    return named.join(hits.where("identity >= 70").select("query"), "query", "left_semi").select("gid")


@query("U03_undirected_pairs", "fx_hits", """SELECT a, b, min(pos) AS pos FROM (SELECT least(query, replace(target, 'T', 'LT')) AS a, greatest(query, replace(target, 'T', 'LT')) AS b, pos FROM fx_hits
WHERE query <> replace(target, 'T', 'LT') AND identity >= 70) GROUP BY a, b""")  # fmt: skip
def u03(hits):
    other = F.replace("target", F.lit("T"), F.lit("LT"))
    far = hits.where((F.col("query") != other) & (F.col("identity") >= 70))
    return far.groupBy(F.least(F.col("query"), other).alias("a"), F.greatest(F.col("query"), other).alias("b")).agg(F.min("pos").alias("pos"))


@query("U06_secreted_set", "fx_hits", """SELECT query FROM (SELECT query, max(CASE WHEN source = 'homology' THEN 1 ELSE 0 END) AS sp, sum(CASE WHEN source = 'family' THEN 1 ELSE 0 END) AS tm FROM fx_hits GROUP BY query) WHERE sp = 1 AND tm = 0""")
def u06(hits):
    signal = hits.where("source = 'homology'").select("query").distinct()
    return signal.join(hits.where("source = 'family'").select("query"), "query", "left_anti")


@query("K17_augustus_hints", "fx_hits", "SELECT query, least(hmm_from, hmm_to) AS h_start, greatest(hmm_from, hmm_to) AS h_end, CASE source WHEN 'homology' THEN 'CDSpart' ELSE 'intron' END AS kind, concat('src=P;pri=4;grp=', target) AS attrs FROM fx_hits")
def k17(hits):
    kind = F.when(F.col("source") == "homology", "CDSpart").otherwise("intron")
    return hits.select("query", F.least("hmm_from", "hmm_to").alias("h_start"), F.greatest("hmm_from", "hmm_to").alias("h_end"), kind.alias("kind"), F.concat(F.lit("src=P;pri=4;grp="), "target").alias("attrs"))


@query("S12_read_blast6", "fx_hits", "SELECT query, target, round(identity, 6) AS identity, evalue, round(bitscore, 6) AS bitscore FROM fx_hits")
def s12(hits):
    lines = hits.select(F.concat_ws("\t", "query", "target", F.col("identity").cast("string"), F.col("evalue").cast("string"), F.col("bitscore").cast("string")).alias("value"))
    return parse_blast6(lines.union(hits.sparkSession.createDataFrame([("# comment",)], "value string"))).withColumns({"identity": F.round("identity", 6), "bitscore": F.round("bitscore", 6)})


def parse_blast6(lines: DataFrame) -> DataFrame:
    """Tabular hits; comments skipped, a bad e-value counts as infinite."""
    p = F.split("value", "\t")
    number = lambda k: F.get(p, F.lit(k)).try_cast("double")
    rows = lines.where(~F.col("value").startswith("#") & (F.size(p) >= 5))
    return rows.select(*carried(rows), F.get(p, F.lit(0)).alias("query"), F.get(p, F.lit(1)).alias("target"), number(2).alias("identity"), F.coalesce(number(3), F.lit(float("inf"))).alias("evalue"), number(4).alias("bitscore"))


@query("S13_read_domtblout", "fx_hits", "SELECT query, target, CAST(dom_len AS BIGINT) AS dom_len, evalue, CAST(hmm_from AS BIGINT) AS a, CAST(hmm_to AS BIGINT) AS b FROM fx_hits")
def s13(hits):
    cols = ["target", F.lit("-"), F.col("dom_len"), "query", *[F.lit("-")] * 8, F.col("evalue"), *[F.lit("0")] * 4, F.col("hmm_from"), F.col("hmm_to"), *[F.lit("0")] * 4]
    lines = hits.select(F.concat_ws("  ", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]).alias("value"))
    return parse_domains(lines)


def parse_domains(lines: DataFrame, by_target: bool = True) -> DataFrame:
    """Per-domain search tables of at least 22 blank-separated fields; the domain is the table's target, or its query."""
    p = F.split(F.trim("value"), r"\s+")
    at = lambda k: F.get(p, F.lit(k))
    rows = lines.where(~F.col("value").startswith("#") & (F.size(p) >= 22))
    query_, target, size = (3, 0, 2) if by_target else (0, 3, 5)
    return rows.select(*carried(rows), at(query_).alias("query"), at(target).alias("target"), at(size).try_cast("long").alias("dom_len"), at(12).try_cast("double").alias("evalue"), at(17).try_cast("long").alias("a"), at(18).try_cast("long").alias("b"))
