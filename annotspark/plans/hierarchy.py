"""Feature hierarchies and their validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annotspark.registry import query
from annotspark.tables import written


def ids(features: DataFrame) -> DataFrame:
    """One row per id; where an id repeats, the row of the first bounds, with a locus tag that any of them has."""
    row = F.min(F.struct("lvl", "f_start", "f_end", "parent", "type"))
    one = features.where("id IS NOT NULL").groupBy("id").agg(row.alias("x"), F.min("locus_tag").alias("locus_tag"))
    return one.select("id", *[F.col(f"x.{c}").alias(c) for c in ("parent", "type", "f_start", "f_end")], "locus_tag")


_IDS = "SELECT id, min(parent) AS parent, min(type) AS type, min(f_start) AS f_start, min(f_end) AS f_end, min(locus_tag) AS locus_tag FROM fx_feature GROUP BY id"


@query("J01_descend_hierarchy", "fx_feature", """SELECT g.id AS gene, m.id AS id, 1 AS depth FROM (SELECT DISTINCT id FROM fx_feature WHERE type = 'gene') g JOIN fx_feature m ON m.parent = g.id
UNION ALL SELECT g.id, c.id, 2 FROM (SELECT DISTINCT id FROM fx_feature WHERE type = 'gene') g JOIN fx_feature m ON m.parent = g.id JOIN fx_feature c ON c.parent = m.id""")  # fmt: skip
def j01(features, depth: int = 2):
    """Children at any depth by repeated equi-joins; the depth of the format is fixed."""
    genes = features.where("type = 'gene'").select(F.col("id").alias("gene"), F.col("id").alias("at")).distinct()
    child = features.select(F.col("parent").alias("at"), F.col("id").alias("next"))
    out, now = None, genes
    for k in range(1, depth + 1):
        now = now.join(child, "at").select("gene", F.col("next").alias("at"))
        level = now.select("gene", F.col("at").alias("id"), F.lit(k).alias("depth"))
        out = level if out is None else out.unionByName(level)
    return out


@query("J02_gene_of_transcript", "fx_feature", f"""SELECT c.id, coalesce(g.locus_tag, g.id, m.id, c.id) AS locus FROM fx_feature c LEFT JOIN ({_IDS}) m ON m.id = c.parent LEFT JOIN ({_IDS}) g ON g.id = m.parent WHERE c.type = 'CDS'""")
def j02(features):
    """Segments without a parent, or whose transcript has none, stay out of the join that would look it up."""
    known = written(ids(features), "ids")
    m = known.select(F.col("id").alias("parent"), F.col("id").alias("m_id"), F.col("parent").alias("m_parent"))
    g = known.select(F.col("id").alias("m_parent"), F.col("id").alias("g_id"), F.col("locus_tag").alias("g_tag"))
    cds = features.where("type = 'CDS'").select("id", "parent")
    met = _looked_up(_looked_up(cds, m, "parent"), g, "m_parent")
    return met.select("id", F.coalesce("g_tag", "g_id", "m_id", "id").alias("locus"))


def _looked_up(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """A left join by a key that may be null, without the null rows meeting in one task."""
    return rows.where(F.col(key).isNotNull()).join(known, key, "left").unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


@query("J03_attr_from_ancestors", "fx_feature", f"""SELECT c.id, coalesce(c.locus_tag, m.locus_tag, g.locus_tag) AS locus_tag FROM fx_feature c LEFT JOIN ({_IDS}) m ON m.id = c.parent LEFT JOIN ({_IDS}) g ON g.id = m.parent""")
def j03(features, hops: int = 8):
    """The nearest locus tag up the parent chain: rows leave as soon as they have one, or no parent to ask."""
    known = written(ids(features).select(F.col("id").alias("_at"), F.col("parent").alias("_next"), F.col("locus_tag").alias("_tag")), "ids")
    now = written(features.select("id", F.col("locus_tag").alias("found"), F.col("parent").alias("_at")), "rows")
    done = None
    for hop in range(hops + 1):
        asks = F.col("found").isNull() & F.col("_at").isNotNull() & F.lit(hop < hops)
        left = now.where(~asks).select("id", F.col("found").alias("locus_tag"))
        done = left if done is None else done.unionByName(left)
        now = now.where(asks)
        if hop == hops or now.isEmpty():
            return done
        now = written(now.join(known, "_at", "left").select("id", F.col("_tag").alias("found"), F.col("_next").alias("_at")), "hop")


@query("J07_liftover_seqids", "fx_feature", "SELECT id, CASE WHEN seqid LIKE '%1' THEN concat('scaffold_', substr(seqid, 4)) ELSE seqid END AS seqid FROM fx_feature")
def j07(features):
    names = features.select("seqid").distinct().where("seqid LIKE '%1'").withColumn("new", F.concat(F.lit("scaffold_"), F.expr("substr(seqid, 4)")))
    return features.join(names, "seqid", "left").select("id", F.coalesce("new", "seqid").alias("seqid"))


_CHECKS = f"""SELECT 'duplicate_id' AS category, count(*) AS n FROM (SELECT id FROM fx_feature GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'missing_parent', count(*) FROM fx_feature f WHERE parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_feature p WHERE p.id = f.parent)
UNION ALL SELECT 'reversed', count(*) FROM fx_feature WHERE f_start > f_end
UNION ALL SELECT 'childless_gene', count(*) FROM (SELECT DISTINCT id FROM fx_feature WHERE type = 'gene') g WHERE NOT EXISTS (SELECT 1 FROM fx_feature c WHERE c.parent = g.id)
UNION ALL SELECT 'cds_without_phase', count(*) FROM fx_feature WHERE type = 'CDS' AND phase IS NULL
UNION ALL SELECT 'gene_without_locus_tag', count(*) FROM fx_feature WHERE type = 'gene' AND locus_tag IS NULL"""


@query("V01_validate_features", "fx_feature", _CHECKS)
def v01(features):
    """One count over the features, and one over their ids with those that children name."""
    own = features.agg(
        F.count_if(F.col("f_start") > F.col("f_end")).alias("reversed"),
        F.count_if((F.col("type") == "CDS") & F.col("phase").isNull()).alias("cds_without_phase"),
        F.count_if((F.col("type") == "gene") & F.col("locus_tag").isNull()).alias("gene_without_locus_tag"),
    )
    names = features.groupBy("id").agg(F.count("*").alias("held"), F.max(F.col("type") == "gene").alias("gene")).where("id IS NOT NULL")
    asked = features.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("children"))
    met = names.join(asked, names["id"] == asked["parent"], "full")
    links = met.agg(
        F.count_if(F.col("held") > 1).alias("duplicate_id"),
        F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("children"))), F.lit(0)).alias("missing_parent"),
        F.count_if(F.col("gene") & F.col("children").isNull()).alias("childless_gene"),
    )
    both = own.crossJoin(links)  # one row each
    return both.unpivot([], both.columns, "category", "n")


@query("V09_reparent_bounds", "fx_feature", """WITH c AS (SELECT parent, min(f_start) AS s, max(f_end) AS e FROM fx_feature WHERE parent IS NOT NULL GROUP BY parent), m AS (SELECT f.id, f.parent, least(f_start, s) AS f_start, greatest(f_end, e) AS f_end FROM fx_feature f JOIN c ON c.parent = f.id WHERE type = 'mRNA'),
d AS (SELECT parent, min(f_start) AS s, max(f_end) AS e FROM m GROUP BY parent) SELECT 'mRNA' AS type, id, f_start, f_end FROM m UNION ALL SELECT 'gene', id, least(f_start, s), greatest(f_end, e) FROM fx_feature f JOIN d ON d.parent = f.id WHERE type = 'gene'""")  # fmt: skip
def v09(features):
    """Transcripts widened to their children, and genes to their transcripts as they are then."""

    def widened(rows, children):
        child = children.groupBy(F.col("parent").alias("id")).agg(F.min("f_start").alias("_s"), F.max("f_end").alias("_e"))
        return rows.join(child, "id").withColumn("f_start", F.least("f_start", "_s")).withColumn("f_end", F.greatest("f_end", "_e")).drop("_s", "_e")

    rna = widened(features.where("type = 'mRNA'"), features.where("parent IS NOT NULL"))
    return rna.unionByName(widened(features.where("type = 'gene'"), rna)).select("type", "id", "f_start", "f_end")


@query("V10_synthesise_children", "fx_feature", """SELECT parent, 'exon' AS type, f_start, f_end FROM fx_feature WHERE type = 'CDS' UNION ALL SELECT parent, CASE WHEN strand = '-' THEN 'stop_codon' ELSE 'start_codon' END, min(f_start), min(f_start) + 2 FROM fx_feature WHERE type = 'CDS' GROUP BY parent, strand
UNION ALL SELECT parent, CASE WHEN strand = '-' THEN 'start_codon' ELSE 'stop_codon' END, max(f_end) - 2, max(f_end) FROM fx_feature WHERE type = 'CDS' GROUP BY parent, strand""")  # fmt: skip
def v10(features):
    """What transcripts with coding segments lack: exons as their segments, and codons of three bases at their ends."""
    segs = features.where("type = 'CDS'")
    lacking = lambda rows, kind: rows.join(features.where(F.col("type") == kind).select("parent").distinct(), "parent", "left_anti")
    exons = lacking(segs, "exon").select("parent", F.lit("exon").alias("type"), "f_start", "f_end")
    ends = segs.groupBy("parent", "strand").agg(F.min("f_start").alias("s"), F.max("f_end").alias("e"))
    minus = F.col("strand") == "-"
    at = lambda low: (F.when(low, F.col("s")).otherwise(F.col("e") - 2).alias("f_start"), F.when(low, F.col("s") + 2).otherwise(F.col("e")).alias("f_end"))
    starts = lacking(ends, "start_codon").select("parent", F.lit("start_codon").alias("type"), *at(~minus))
    return exons.unionByName(starts).unionByName(lacking(ends, "stop_codon").select("parent", F.lit("stop_codon").alias("type"), *at(minus)))
