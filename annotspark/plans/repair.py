"""Checks and repairs of feature hierarchies, row by row: issues, made-up parents, names, bounds and cleaned lines.

Functions take features (seqid, type, f_start, f_end, strand, id, parent, and what else there is) and ``keys`` that stand
before ids, such as a genome.  A parent may be a list with commas, of which the first counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annotspark.operators.names import ranked, unique_names
from annotspark.plans.features import padded
from annotspark.plans.formats import parse_gff3
from annotspark.registry import query
from annotspark.tables import written

CHILDREN = ["CDS", "exon", "five_prime_UTR", "three_prime_UTR"]
_KIDS = "('CDS', 'exon', 'five_prime_UTR', 'three_prime_UTR')"


def first_parent(parent: str | Column = "parent") -> Column:
    return F.substring_index(parent, ",", 1)


def _known(features: DataFrame, keys: list[str]) -> DataFrame:
    """One row an id: its type and, of transcripts, the bounds; of repeated ids the row of the last type and bounds."""
    row = F.max(F.struct("type", "f_start", "f_end"))
    one = features.where("id IS NOT NULL").groupBy(*keys, F.col("id").alias("_pid")).agg(row.alias("_p"), F.max(F.when(F.col("type") == "mRNA", F.struct("f_start", "f_end"))).alias("_m"))
    return one.select(*keys, "_pid", F.col("_p.type").alias("_ptype"), F.col("_m.f_start").alias("_ms"), F.col("_m.f_end").alias("_me"))


def with_first_parent(features: DataFrame, keys: list[str]) -> DataFrame:
    """Features with their first parent's id, type and transcript bounds; rows without a parent don't take part in the join."""
    rows = features.withColumn("_pid", first_parent())
    met = rows.where("_pid IS NOT NULL").join(_known(features, keys).withColumn("_found", F.lit(True)), [*keys, "_pid"], "left")
    return met.unionByName(rows.where("_pid IS NULL"), allowMissingColumns=True)


def structure_issues(features: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, kind, type, seqid, f_start, f_end, detail, repairable): one row for each issue of a feature."""
    t, kid = F.col("type"), F.col("type").isin(CHILDREN)
    found = F.coalesce("_found", F.lit(False))
    rows = with_first_parent(features, keys or [])
    one = lambda when, kind, detail, fix: F.when(when, F.struct(F.lit(kind).alias("kind"), detail.alias("detail"), fix.alias("repairable")))
    text = lambda *parts: F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    has = F.col("_pid").isNotNull()
    issues = F.array(
        one(t.isin("gene", "mRNA") & F.col("id").isNull(), "MissingId", text(t, " without an id"), F.lit(True)),
        one(has & ~found, "OrphanParent", text("no feature has the id ", F.col("_pid")), kid | (t == "mRNA")),
        one((t == "mRNA") & found & (F.col("_ptype") != "gene"), "MrnaParentNotGene", text(F.col("_pid"), " is a ", F.col("_ptype")), F.lit(False)),
        one((t == "CDS") & F.col("_ms").isNotNull() & ((F.col("f_start") < F.col("_ms")) | (F.col("f_end") > F.col("_me"))), "CdsOutsideMrna", text("outside of ", F.col("_pid")), F.lit(False)),
        one(~has & (kid | (t == "mRNA")), "MissingParent", text(t, " without a parent"), F.lit(True)),
    )
    return rows.select(*(keys or []), "type", "seqid", "f_start", "f_end", F.explode(F.array_compact(issues)).alias("x")).select(*(keys or []), "x.kind", "type", "seqid", "f_start", "f_end", "x.detail", "x.repairable")


_BROKEN_P = """p AS (SELECT id AS pid, max_by(type, (type, f_start, f_end)) AS ptype FROM fx_broken WHERE id IS NOT NULL GROUP BY id),
t AS (SELECT id AS pid, max((f_start, f_end)) AS b FROM fx_broken WHERE id IS NOT NULL AND type = 'mRNA' GROUP BY id),
f AS (SELECT b.*, string_split(parent, ',')[1] AS fp FROM fx_broken b), j AS (SELECT f.*, p.pid, ptype, t.b FROM f LEFT JOIN p ON p.pid = f.fp LEFT JOIN t ON t.pid = f.fp)"""


@query("V03_check_structure", "fx_broken", f"""WITH {_BROKEN_P} SELECT 'MissingId' AS kind, type, seqid, f_start, f_end, concat(type, ' without an id') AS detail, true AS repairable FROM j WHERE type IN ('gene', 'mRNA') AND id IS NULL
UNION ALL SELECT 'OrphanParent', type, seqid, f_start, f_end, concat('no feature has the id ', fp), type IN {_KIDS} OR type = 'mRNA' FROM j WHERE fp IS NOT NULL AND pid IS NULL
UNION ALL SELECT 'MrnaParentNotGene', type, seqid, f_start, f_end, concat(fp, ' is a ', ptype), false FROM j WHERE type = 'mRNA' AND ptype <> 'gene'
UNION ALL SELECT 'CdsOutsideMrna', type, seqid, f_start, f_end, concat('outside of ', fp), false FROM j WHERE type = 'CDS' AND (f_start < b[1] OR f_end > b[2])
UNION ALL SELECT 'MissingParent', type, seqid, f_start, f_end, concat(type, ' without a parent'), true FROM j WHERE fp IS NULL AND (type IN {_KIDS} OR type = 'mRNA')""")  # fmt: skip
def v03(features):
    return structure_issues(features)


def repair_structure(features: DataFrame, order: list[Column], keys: list[str] | None = None, prefix: str = "fix") -> tuple[DataFrame, DataFrame]:
    """The features with what could be repaired, and the actions (keys, action, type, seqid, f_start, f_end, name).

    1. Genes and transcripts without an id get one, numbered in ``order``.
    2. Transcripts and their parts without a parent get the name of one each, numbered likewise.
    3. Parents that nothing has as its id are made up: a gene above transcripts; a transcript, and a gene above that, over
       parts.  They span their children and are on the first one's contig and strand; coordinates never change.

    Numbers begin behind those that ids of this form already have.  Made-up rows have ``made`` true and nulls in columns
    that aren't theirs.
    """
    keys = keys or []
    features = written(features.withColumn("made", F.lit(False)).withColumn("_pid", first_parent()), "features")
    t, kid = F.col("type"), F.col("type").isin(CHILDREN)
    used = F.regexp_extract("id", f"^{prefix}_(gene|mrna|orphan)_([0-9]{{1,17}})$", 2)
    held = features.select(*keys, F.nullif(used, F.lit("")).cast("long").alias("_k")).groupBy(*keys).agg(F.coalesce(F.max("_k"), F.lit(0)).alias("_first"))

    def numbers(rows: DataFrame) -> DataFrame:
        rows = ranked(rows, keys, order, "_n")
        if not keys:
            return rows.crossJoin(F.broadcast(held)).withColumn("_n", F.col("_n") + F.col("_first")).drop("_first")  # one row
        return rows.join(held, keys).withColumn("_n", F.col("_n") + F.col("_first")).drop("_first")

    lacks_id = t.isin("gene", "mRNA") & F.col("id").isNull()
    lacks_parent = (kid | (t == "mRNA")) & (F.col("_pid").isNull() | (F.col("_pid") == ""))
    lacks_id, lacks_parent = F.coalesce(lacks_id, F.lit(False)), F.coalesce(lacks_parent, F.lit(False))
    nameless = numbers(features.where(lacks_id)).withColumn("id", F.concat(F.lit(f"{prefix}_"), F.lower("type"), F.lit("_"), padded(F.col("_n"), 4))).drop("_n")
    nameless = written(nameless, "nameless")
    step = features.where(~lacks_id).unionByName(nameless)
    alone = numbers(step.where(lacks_parent)).withColumn("_pid", F.concat(F.lit(f"{prefix}_orphan_"), padded(F.col("_n"), 4))).withColumn("parent", F.col("_pid")).drop("_n")
    alone = written(alone, "alone")
    step = step.where(~lacks_parent).unionByName(alone)
    ids = step.where("id IS NOT NULL").select(*keys, "id").distinct()
    orphans = step.where("_pid IS NOT NULL").join(ids.withColumnRenamed("id", "_pid"), [*keys, "_pid"], "left_anti")
    head = F.min_by(F.struct("seqid", "strand"), F.struct(*[F.col(c) for c in ("seqid", "f_start", "f_end", "type")], F.coalesce("id", F.lit("")))).alias("_h")
    lost = orphans.groupBy(*keys, "_pid").agg(head, F.min("f_start").alias("f_start"), F.max("f_end").alias("f_end"), F.max(t == "mRNA").alias("_rna"), F.count("*").alias("_c"))
    lost = written(lost.withColumn("gene", F.concat("_pid", F.lit(".gene"))), "lost")
    over = lost.where("NOT _rna")
    over = unique_names(over, "gene", [F.asc("_pid")], keys, ids.withColumnRenamed("id", "gene"))
    row = lambda kind, own, up: [*keys, F.col("_h.seqid").alias("seqid"), F.lit(kind).alias("type"), "f_start", "f_end", F.col("_h.strand").alias("strand"), own.alias("id"), up.alias("parent"), F.lit(True).alias("made"), "_c"]
    none = F.lit(None).cast("string")
    made = lost.where("_rna").select(row("gene", F.col("_pid"), none)).unionByName(over.select(row("gene", F.col("gene"), none))).unionByName(over.select(row("mRNA", F.col("_pid"), F.col("gene"))))
    made = written(made, "made")
    out = step.drop("_pid").unionByName(made.drop("_c"), allowMissingColumns=True)
    act = lambda rows, kind, name: rows.select(*keys, F.lit(kind).alias("action"), "type", "seqid", "f_start", "f_end", F.col(name).alias("name"))
    actions = act(nameless, "assigned id", "id").unionByName(act(alone, "named a parent", "parent")).unionByName(act(made, "made up", "id"))
    return out, actions


def _order() -> list[Column]:
    return [*map(F.asc, ("seqid", "f_start", "f_end", "lvl", "gid")), F.asc_nulls_first("id"), F.asc_nulls_first("locus_tag")]


_SQL_ORDER = "seqid, f_start, f_end, lvl, gid, id NULLS FIRST, locus_tag NULLS FIRST"
_PAD4 = "lpad(CAST({0} AS VARCHAR), CAST(greatest(4, length(CAST({0} AS VARCHAR))) AS INTEGER), '0')"


@query("V04_repair_structure", "fx_broken", f"""WITH a AS (SELECT *, CASE WHEN type IN ('gene', 'mRNA') AND id IS NULL THEN concat('fix_', lower(type), '_', {_PAD4.format("row_number() OVER (PARTITION BY type IN ('gene', 'mRNA') AND id IS NULL ORDER BY " + _SQL_ORDER + ")")}) ELSE id END AS nid FROM fx_broken),
b AS (SELECT *, CASE WHEN (type = 'mRNA' OR type IN {_KIDS}) AND parent IS NULL THEN concat('fix_orphan_', {_PAD4.format("row_number() OVER (PARTITION BY (type = 'mRNA' OR type IN " + _KIDS + ") AND parent IS NULL ORDER BY " + _SQL_ORDER.replace("id NULLS", "nid NULLS") + ")")}) ELSE parent END AS np FROM a),
o AS (SELECT *, string_split(np, ',')[1] AS fp FROM b WHERE np IS NOT NULL AND string_split(np, ',')[1] NOT IN (SELECT nid FROM b WHERE nid IS NOT NULL)),
l AS (SELECT fp, min_by(struct_pack(s := seqid, t := strand), (seqid, f_start, f_end, type, coalesce(nid, ''))) AS h, min(f_start) AS f_start, max(f_end) AS f_end, bool_or(type = 'mRNA') AS rna FROM o GROUP BY fp)
SELECT type, seqid, f_start, f_end, strand, nid AS id, np AS parent, false AS made FROM b UNION ALL SELECT 'gene', h.s, f_start, f_end, h.t, CASE WHEN rna THEN fp ELSE concat(fp, '.gene') END, NULL, true FROM l
UNION ALL SELECT 'mRNA', h.s, f_start, f_end, h.t, fp, concat(fp, '.gene'), true FROM l WHERE NOT rna""")  # fmt: skip
def v04(features):
    out, _ = repair_structure(features, _order())
    return out.select("type", "seqid", "f_start", "f_end", "strand", "id", "parent", "made")


def drop_orphans_and_fix(features: DataFrame, order: list[Column], keys: list[str] | None = None) -> DataFrame:
    """Features whose first parent is there, ids unique, bounds in order; ``renamed`` and ``turned`` say what was done."""
    keys = keys or []
    known = features.where("id IS NOT NULL").select(*keys, F.col("id").alias("_pid")).distinct()
    rows = features.withColumn("_pid", F.col("parent"))
    kept = rows.where("_pid IS NULL").unionByName(rows.where("_pid IS NOT NULL").join(known, [*keys, "_pid"], "left_semi")).drop("_pid")
    turned = F.col("f_start") > F.col("f_end")
    kept = kept.withColumn("_was", F.col("id")).withColumn("turned", F.coalesce(turned, F.lit(False)))
    named = unique_names(written(kept, "kept"), "id", order, keys).withColumn("renamed", F.coalesce(F.col("id") != F.col("_was"), F.lit(False))).drop("_was")
    return named.withColumn("_a", F.least("f_start", "f_end")).withColumn("f_end", F.greatest("f_start", "f_end")).withColumn("f_start", F.col("_a")).drop("_a")


#: Ids as they are, a third of which already look like a second holder's name.
_NAMED = """SELECT * REPLACE (CASE WHEN type = 'CDS' AND gid % 3 = 0 THEN concat('g', gid) WHEN type = 'CDS' AND gid % 3 = 1 THEN concat('g', gid, '_dup', 2 + (gid + CAST(right(id, 1) AS BIGINT)) % 3) ELSE id END AS id) FROM fx_feature"""
_USED = "SELECT DISTINCT regexp_extract(id, '^(.*)_dup([1-9][0-9]*)$', 1) AS base, CAST(regexp_extract(id, '^(.*)_dup([1-9][0-9]*)$', 2) AS BIGINT) AS t FROM ({0}) WHERE regexp_matches(id, '^(.*)_dup([1-9][0-9]*)$')"
#: The n-th holder's name: of the numbers from 2 on that no row has, the (n - 1)-th.
_UNIQUE = """u AS (""" + _USED + """ ), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {1}) AS r FROM ({0})),
m AS (SELECT id AS mid, max(r) AS most FROM k WHERE id IS NOT NULL GROUP BY id HAVING max(r) > 1), w AS (SELECT mid, most, unnest(range(2, most + 1 + (SELECT count(*) FROM u WHERE base = mid))) AS v FROM m),
fr AS (SELECT mid, v, row_number() OVER (PARTITION BY mid ORDER BY v) AS j FROM w WHERE NOT EXISTS (SELECT 1 FROM u WHERE base = mid AND t = v)),
d AS (SELECT k.*, CASE WHEN r > 1 AND id IS NOT NULL THEN concat(id, '_dup', v) ELSE id END AS name FROM k LEFT JOIN fr ON fr.mid = k.id AND fr.j = k.r - 1)"""


def renamed_ids(features: DataFrame) -> DataFrame:
    part = F.substring("id", -1, 1).cast("long")
    name = F.concat(F.lit("g"), F.col("gid").cast("string"))
    cds = F.col("type") == "CDS"
    return features.withColumn("id", F.when(cds & (F.col("gid") % 3 == 0), name).when(cds & (F.col("gid") % 3 == 1), F.concat(name, F.lit("_dup"), (2 + (F.col("gid") + part) % 3).cast("string"))).otherwise(F.col("id")))


def _dup_order() -> list[Column]:
    return [*map(F.asc, ("lvl", "f_start", "f_end")), F.asc_nulls_first("locus_tag")]


_SQL_DUP = "lvl, f_start, f_end, locus_tag NULLS FIRST"


@query("W06_dup_suffix", "fx_feature", f"WITH {_UNIQUE.format(_NAMED, _SQL_DUP)} SELECT type, gid, f_start, f_end, name AS id FROM d")
def w06(features):
    """Every id once: further holders get the least numbers that no row has."""
    return unique_names(written(renamed_ids(features), "named"), "id", _dup_order()).select("type", "gid", "f_start", "f_end", "id")


_FIXED = f"(SELECT * REPLACE (CASE WHEN gid % 6 = 0 THEN f_end ELSE f_start END AS f_start, CASE WHEN gid % 6 = 0 THEN f_start ELSE f_end END AS f_end) FROM ({_NAMED}))"
_KEPT = f"SELECT * FROM {_FIXED} WHERE parent IS NULL OR parent IN (SELECT id FROM {_FIXED} WHERE id IS NOT NULL)"


@query("V05_drop_orphans_and_fix", "fx_feature", f"WITH {_UNIQUE.format(_KEPT, _SQL_DUP)} SELECT type, gid, name AS id, least(f_start, f_end) AS f_start, greatest(f_start, f_end) AS f_end, coalesce(name <> id, false) AS renamed, f_start > f_end AS turned FROM d")
def v05(features):
    """Features with repeated ids, a sixth of them with bounds the wrong way round."""
    a, b = F.col("f_start"), F.col("f_end")
    turn = F.col("gid") % 6 == 0
    rows = renamed_ids(features).withColumn("_a", F.when(turn, b).otherwise(a)).withColumn("f_end", F.when(turn, a).otherwise(b)).withColumn("f_start", F.col("_a")).drop("_a")
    return drop_orphans_and_fix(written(rows, "rows"), _dup_order()).select("type", "gid", "id", "f_start", "f_end", "renamed", "turned")


def submission_checks(features: DataFrame, contigs: DataFrame, most: int = 16) -> DataFrame:
    """(check, n, fatal): every repeat of an id, orphans, features by type, genes without a locus tag or a product, contigs
    that are missing, and contig names that are too long."""
    t = F.col("type")
    own = features.agg(
        *[F.count_if(t == k).alias(f"{k}_features") for k in ("gene", "CDS", "tRNA", "rRNA")],
        F.count_if((t == "gene") & F.col("locus_tag").isNull()).alias("genes_without_locus_tag"), F.count_if((t == "CDS") & F.col("product").isNull()).alias("cds_without_product"),
    )
    ids = features.where("id IS NOT NULL").groupBy("id").agg((F.count("*") - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("repeated_ids"))
    orphans = features.where("parent IS NOT NULL").groupBy(first_parent().alias("_pid")).agg(F.count("*").alias("n"))
    orphans = orphans.join(features.where("id IS NOT NULL").select(F.col("id").alias("_pid")).distinct(), "_pid", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))
    names = features.select("seqid").distinct()
    missing = names.join(contigs.select("seqid").distinct(), "seqid", "left_anti").agg(F.count("*").alias("contigs_without_sequence"))
    long = names.agg(F.count_if(F.length("seqid") > most).alias("long_contig_names"))
    row = own.crossJoin(ids).crossJoin(orphans).crossJoin(missing).crossJoin(long)  # one row each
    fatal = F.col("check").isin("repeated_ids", "orphans", "genes_without_locus_tag", "contigs_without_sequence") & (F.col("n") > 0)
    return row.unpivot([], row.columns, "check", "n").withColumn("fatal", fatal)


_CHECKED = "(SELECT *, CASE WHEN type = 'CDS' AND gid % 9 <> 0 THEN 'kinase' END AS product FROM fx_broken)"


@query("V02_validate_submission", "fx_broken fx_ctg", f"""WITH f AS (SELECT * FROM {_CHECKED}), c AS (SELECT 'gene_features' AS "check", count(*) FILTER (WHERE type = 'gene') AS n FROM f UNION ALL SELECT 'CDS_features', count(*) FILTER (WHERE type = 'CDS') FROM f
UNION ALL SELECT 'tRNA_features', count(*) FILTER (WHERE type = 'tRNA') FROM f UNION ALL SELECT 'rRNA_features', count(*) FILTER (WHERE type = 'rRNA') FROM f
UNION ALL SELECT 'genes_without_locus_tag', count(*) FILTER (WHERE type = 'gene' AND locus_tag IS NULL) FROM f UNION ALL SELECT 'cds_without_product', count(*) FILTER (WHERE type = 'CDS' AND product IS NULL) FROM f
UNION ALL SELECT 'repeated_ids', count(id) - count(DISTINCT id) FROM f UNION ALL SELECT 'orphans', count(*) FROM f WHERE string_split(parent, ',')[1] NOT IN (SELECT id FROM f WHERE id IS NOT NULL)
UNION ALL SELECT 'contigs_without_sequence', count(*) FROM (SELECT DISTINCT seqid FROM f WHERE seqid NOT IN (SELECT seqid FROM fx_ctg)) UNION ALL SELECT 'long_contig_names', count(DISTINCT seqid) FROM f WHERE length(seqid) > 5)
SELECT "check", n, "check" IN ('repeated_ids', 'orphans', 'genes_without_locus_tag', 'contigs_without_sequence') AND n > 0 AS fatal FROM c""")  # fmt: skip
def v02(features, contigs):
    product = F.when((F.col("type") == "CDS") & (F.col("gid") % 9 != 0), "kinase")
    return submission_checks(features.withColumn("product", product), contigs, most=5)


def clean_lines(lines: DataFrame, least: int = 0, swap: bool = True, drop_orphans: bool = False) -> DataFrame:
    """GFF3 rows with ``action``: ``kept``, ``swapped`` (bounds the wrong way round), ``raised`` (a start of 0 becomes 1),
    ``short``, ``orphan`` or ``unparseable``; the first two and the third are the cleaned rows."""
    rows = parse_gff3(lines, ["ID", "Parent"] if drop_orphans else None)
    p = F.split("_error", "\t")
    a, b = F.get(p, F.lit(3)).try_cast("long"), F.get(p, F.lit(4)).try_cast("long")
    again = F.col("_error").isNotNull() & (F.size(p) == 9) & (a > b) & F.lit(swap)
    rows = rows.withColumn("_s", F.coalesce(again, F.lit(False))).withColumn("start", F.when(F.col("_s"), b).otherwise(F.col("start"))).withColumn("end", F.when(F.col("_s"), a).otherwise(F.col("end")))
    rows = rows.withColumn("_z", F.coalesce(F.col("start") == 0, F.lit(False))).withColumn("start", F.when(F.col("_z"), 1).otherwise(F.col("start")))
    action = (
        F.when(F.col("_error").isNotNull() & ~F.col("_s"), "unparseable").when(F.col("end") - F.col("start") + 1 < least, "short")
        .when(F.col("_s"), "swapped").when(F.col("_z"), "raised").otherwise("kept")
    )
    rows = rows.withColumn("action", action).drop("_s", "_z", "_error")
    if not drop_orphans:
        return rows
    rows = rows.withColumn("_pid", first_parent("_Parent"))
    # rows without a parent meet nothing, and are dealt by what they are: one look at all of them in place of two
    rows = rows.withColumn("_key", F.struct(F.col("_pid").alias("id"), F.when(F.col("_pid").isNull(), F.xxhash64("seqid", "start", "end")).alias("rest")))
    # no filter: pushed below the parsing, it would parse a line again at every place where it names a field
    own = F.when(F.col("action").isin("kept", "swapped", "raised"), F.col("_ID"))
    ids = rows.select(F.struct(own.alias("id"), F.lit(None).cast("long").alias("rest")).alias("_key")).distinct().withColumn("_is", F.lit(True))
    met = rows.join(ids, "_key", "left").drop("_key", "_ID", "_Parent")
    lost = F.col("_pid").isNotNull() & F.col("_is").isNull() & F.col("action").isin("kept", "swapped", "raised")
    return met.withColumn("action", F.when(lost, "orphan").otherwise(F.col("action"))).drop("_pid", "_is")


_ROWS = "(SELECT *, CASE WHEN gid % 10 = 0 THEN 'reversed' WHEN gid % 10 = 1 THEN 'bad' WHEN gid % 10 = 2 THEN 'zero' ELSE 'fine' END AS how FROM fx_feature)"


@query("V06_clean_features", "fx_feature", f"""WITH r AS (SELECT *, CASE WHEN how = 'zero' THEN 0 ELSE f_start END AS s FROM {_ROWS}), a AS (SELECT type, id, parent, greatest(CASE WHEN how = 'reversed' THEN least(s, f_end) ELSE s END, 1) AS start, f_end AS "end",
CASE WHEN how = 'bad' THEN 'unparseable' WHEN f_end - greatest(s, 1) + 1 < 100 THEN 'short' WHEN how = 'reversed' AND s < f_end THEN 'swapped' WHEN how = 'zero' THEN 'raised' ELSE 'kept' END AS action FROM r),
o AS (SELECT *, CASE WHEN action IN ('kept', 'swapped', 'raised') AND parent IS NOT NULL AND parent NOT IN (SELECT id FROM a WHERE id IS NOT NULL AND action IN ('kept', 'swapped', 'raised')) THEN 'orphan' ELSE action END AS act FROM a)
SELECT act AS action, count(*) AS n, CAST(sum(CASE WHEN act IN ('kept', 'swapped', 'raised') THEN start END) AS BIGINT) AS starts, CAST(sum(CASE WHEN act IN ('kept', 'swapped', 'raised') THEN "end" END) AS BIGINT) AS ends FROM o GROUP BY act""")  # fmt: skip
def v06(features):
    """Lines of which a tenth each are the wrong way round, without a number, or begin at 0."""
    how = F.col("gid") % 10
    start = F.when(how == 2, F.lit(0)).otherwise(F.col("f_start"))
    a = F.when(how == 0, F.col("f_end").cast("string")).when(how == 1, F.lit("x")).otherwise(start.cast("string"))
    b = F.when(how == 0, F.col("f_start")).otherwise(F.col("f_end")).cast("string")
    attrs = F.concat_ws(";", F.concat(F.lit("ID="), "id"), F.concat(F.lit("Parent="), "parent"))
    lines = features.select(F.concat_ws("\t", "seqid", F.lit("x"), "type", a, b, F.lit("."), "strand", F.lit("."), attrs).alias("value"))
    done = clean_lines(written(lines, "lines"), 100, drop_orphans=True)
    good = F.col("action").isin("kept", "swapped", "raised")
    return done.groupBy("action").agg(F.count("*").alias("n"), F.sum(F.when(good, F.col("start"))).alias("starts"), F.sum(F.when(good, F.col("end"))).alias("ends"))
