"""Readers of reads, masks, hit tables, sample sheets and run reports.

Each parser takes lines (``value``, and ``file`` and ``n`` where a line's place counts);
:mod:`annotspark.plans.paths` has the same for paths.  The registered queries render lines from the driver's tables and read them back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.plans.features import padded
from annotspark.registry import query
from annotspark.sources import carried


def _tabs(k: int) -> Column:
    return F.get(F.split("value", "\t"), F.lit(k))


def _list(cell: Column, sep: str = ",") -> Column:
    """The parts of a cell; a dash, an empty or a missing one has none."""
    none = cell.isNull() | cell.isin("-", "")
    return F.when(none, F.array().cast("array<string>")).otherwise(F.transform(F.split(cell, sep), lambda x: F.trim(x)))


def parse_fastq(rows: DataFrame) -> DataFrame:
    """(file, id, description, seq, quality, _error) of four-line records; qualities are letter codes less 33."""
    part = lambda k: F.max(F.when(F.col("n") % 4 == k, F.col("value")))
    one = rows.groupBy(*carried(rows), "file", F.floor(F.col("n") / 4).alias("record")).agg(part(0).alias("head"), part(1).alias("seq"), part(3).alias("q"))
    letters = F.filter(F.split("q", ""), lambda c: c != "")
    name = F.substring("head", F.lit(2), F.length("head"))
    bad = F.when(~F.col("head").startswith("@"), F.lit("header without @")).when(F.col("q").isNull() | (F.length("q") != F.length("seq")), F.lit("qualities don't fit the sequence"))
    return one.select(*carried(one), "file", "record", F.substring_index(name, " ", 1).alias("id"), name.alias("description"), "seq", F.transform(letters, lambda c: F.ascii(c) - 33).alias("quality"), bad.alias("_error"))


@query("S03_read_fastq", "fx_seq", """SELECT seq_id, concat('r', CAST(seq_id AS VARCHAR)) AS id, seq, CAST(40 * length(regexp_replace(seq, '[^a-z]', '', 'g')) + 41 * length(regexp_replace(seq, '[^A-Z]', '', 'g')) AS BIGINT) AS quality
FROM fx_seq WHERE length(seq) > 0""")  # fmt: skip
def s03(seqs):
    quality = F.translate("seq", "acgtACGT", "IIIIJJJJ")
    four = F.array(F.concat(F.lit("@r"), F.col("seq_id").cast("string"), F.lit(" read")), "seq", F.lit("+"), quality)
    rows = seqs.where("length(seq) > 0").select(F.col("seq_id").alias("file"), F.posexplode(four).alias("n", "value"))
    found = parse_fastq(rows).where("_error IS NULL")
    return found.select(F.col("file").alias("seq_id"), "id", "seq", F.aggregate("quality", F.lit(0), lambda t, x: t + x).cast("long").alias("quality"))


def parse_qual(records: DataFrame) -> DataFrame:
    """(id, quality) of records cut at ``>``: the numbers behind the header line, what isn't one is left out."""
    text = F.regexp_replace("value", "^>", "")
    head, body = F.substring_index(text, "\n", 1), F.regexp_replace("value", "^>?[^\n]*\n", "")
    numbers = F.filter(F.transform(F.split(F.trim(body), r"\s+"), lambda x: x.try_cast("smallint")), lambda x: x.isNotNull() & x.between(0, 255))
    return records.where(F.contains("value", F.lit("\n"))).select(*carried(records), F.substring_index(head, " ", 1).alias("id"), numbers.alias("quality"))


@query("S04_read_qual", "fx_quant", "SELECT concat(transcript, '_', sample) AS id, 2 AS n, CAST(transcript[3:] AS BIGINT) % 250 + 7 AS total FROM fx_quant")
def s04(quant):
    number = (F.substring("transcript", 3, 20).cast("long") % 250).cast("string")
    text = F.concat(F.lit(">"), F.concat_ws("_", "transcript", "sample"), F.lit(" qualities\n"), number, F.lit(" x\n-\t7 999\n"))
    found = parse_qual(quant.select(text.alias("value")))
    return found.select("id", F.size("quality").alias("n"), F.aggregate("quality", F.lit(0).cast("long"), lambda t, x: t + x).alias("total"))


def parse_repeatmasker(rows: DataFrame, min_length: int = 0) -> DataFrame:
    """(file, seqid, start, end) with starts from 0, behind three header lines of each file."""
    p = F.split(F.trim("value"), r"\s+")
    at = lambda k: F.get(p, F.lit(k))
    found = rows.where("n >= 3").select(*carried(rows), "file", at(4).alias("seqid"), (at(5).try_cast("long") - 1).alias("start"), at(6).try_cast("long").alias("end"))
    return found.where((F.col("end") - F.col("start") >= min_length) & (F.col("end") > F.col("start")))


@query("S08_read_repeatmasker_out", "fx_gene", "SELECT seqid, g_start - 1 AS start, g_end AS \"end\" FROM fx_gene WHERE g_end - g_start + 1 >= 300")
def s08(genes):
    one = F.format_string("  239   29.4  1.9  1.0  %s  %d %d (0) C  rnd-1  Unknown", "seqid", "g_start", "g_end")
    heads = F.array(F.lit("   SW  perc perc perc  query"), F.lit("score  div. del. ins.  sequence"), F.lit(""))
    rows = genes.select(F.concat_ws("/", "seqid", F.col("gid").cast("string")).alias("file"), F.posexplode(F.concat(heads, F.array(one))).alias("n", "value"))
    return parse_repeatmasker(rows, 300).select("seqid", "start", "end")


def parse_emapper(rows: DataFrame, order: list | None = None) -> DataFrame:
    """Orthology annotations of at least 12 fields; the last row of a query wins (by ``order``)."""
    found = rows.where(~F.trim("value").startswith("#") & (F.size(F.split("value", "\t")) >= 12))
    keys = carried(rows)
    out = found.select(
        *keys, _tabs(0).alias("query"), _tabs(4).alias("og"), _tabs(6).alias("cog"), _tabs(7).alias("description"), _tabs(8).alias("name"), _list(_tabs(9)).alias("go"), _list(_tabs(12)).alias("kegg"),
        *[F.col(c).alias(f"_{k}") for k, c in enumerate(order or [])],
    )
    if not order:
        return out
    w = Window.partitionBy(*keys, "query").orderBy(*[F.desc(f"_{k}") for k in range(len(order))])
    return out.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", *[f"_{k}" for k in range(len(order))])


@query("S14_read_emapper", "fx_hits", """SELECT query, concat('COG', CAST(partkey % 90 AS VARCHAR)) AS og, target AS description, CASE WHEN partkey % 3 = 0 THEN 0 ELSE 2 END AS n_go, CASE WHEN partkey % 2 = 0 THEN 0 ELSE 1 END AS n_kegg
FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY pos DESC, partkey DESC) AS r FROM fx_hits) WHERE r = 1""")  # fmt: skip
def s14(hits):
    text = lambda c: F.col(c).cast("string")
    go = F.when(F.col("partkey") % 3 == 0, "-").otherwise(F.concat(F.lit("GO:1, GO:"), text("partkey")))
    kegg = F.when(F.col("partkey") % 2 == 0, "").otherwise(F.concat(F.lit("ko"), text("partkey")))
    og = F.concat(F.lit("COG"), (F.col("partkey") % 90).cast("string"))
    line = F.concat_ws("\t", "query", F.lit("seed"), text("evalue"), text("bitscore"), og, F.lit("2759"), F.lit("S"), "target", F.lit("abc"), go, F.lit("-"), F.lit("ko:1"), kegg)
    found = parse_emapper(hits.select(line.alias("value"), "pos", "partkey"), ["pos", "partkey"])
    return found.select("query", "og", "description", F.size("go").alias("n_go"), F.size("kegg").alias("n_kegg"))


def parse_dbcan(rows: DataFrame) -> DataFrame:
    """(gene, family, method): one row for each family that a method names; ranges in brackets are cut off."""
    kept = rows.where(~F.col("value").rlike(r"^(#|Gene ID|\s*$)") & (F.size(F.split("value", "\t")) >= 4))
    keys = carried(rows)
    wide = kept.select(*keys, _tabs(0).alias("gene"), F.explode(F.array(*[F.struct(F.lit(m).alias("method"), _tabs(k).alias("cell")) for k, m in enumerate(("HMMER", "Hotpep", "DIAMOND"), 1)])).alias("x"))
    parts = wide.where("x.cell <> '-'").select(*keys, "gene", "x.method", F.explode(F.split("x.cell", r"\+")).alias("part"))
    return parts.select(*keys, "gene", F.trim(F.substring_index("part", "(", 1)).alias("family"), "method").where("family <> ''")


@query("S16_read_dbcan_overview", "fx_hits", """SELECT query AS gene, concat('GH', CAST(partkey % 120 AS VARCHAR)) AS family, 'HMMER' AS method FROM fx_hits UNION ALL SELECT query, 'CBM1', 'HMMER' FROM fx_hits
UNION ALL SELECT query, concat('AA', CAST(partkey % 9 AS VARCHAR)), 'DIAMOND' FROM fx_hits WHERE partkey % 4 <> 0""")  # fmt: skip
def s16(hits):
    n = lambda k: (F.col("partkey") % k).cast("string")
    line = F.concat_ws("\t", "query", F.concat(F.lit("GH"), n(120), F.lit("(12-90)+CBM1(100-130)")), F.lit("-"), F.when(F.col("partkey") % 4 == 0, "-").otherwise(F.concat(F.lit("AA"), n(9))), F.lit("2"))
    return parse_dbcan(hits.select(line.alias("value")))


def parse_trnascan(rows: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """tRNA genes: a begin behind the end is the minus strand; intron bounds in order, null where there is none.

    Columns in ``carry`` are passed on.
    """
    p = F.split(F.trim("value"), r"\s+")
    at = lambda k: F.get(p, F.lit(k))
    num = lambda k: F.coalesce(at(k).try_cast("long"), F.lit(0))
    kept = rows.where(~F.trim("value").rlike(r"^(Sequence|Name|-|#|$)") & (F.size(p) >= 9))
    note = F.array_join(F.slice(p, F.lit(10), F.greatest(F.size(p) - 9, F.lit(0))), " ")
    intron = (num(6) > 0) & (num(7) > 0)
    return kept.select(
        *carried(rows), *(carry or []), at(0).alias("seqid"), F.least(num(2), num(3)).alias("start"), F.greatest(num(2), num(3)).alias("end"), F.when(num(2) > num(3), "-").otherwise("+").alias("strand"),
        at(4).alias("amino_acid"), at(5).alias("anticodon"), F.when(intron, F.least(num(6), num(7))).alias("intron_start"), F.when(intron, F.greatest(num(6), num(7))).alias("intron_end"),
        F.coalesce(at(8).try_cast("double"), F.lit(0.0)).alias("score"), (at(4).isin("Pseudo", "Undet") | F.contains(note, F.lit("pseudo"))).alias("pseudo"),
    )


def trna_lines(genes: DataFrame) -> DataFrame:
    """tRNA table rows out of gene places: minus strand swapped, every third with an intron, every seventh a pseudogene."""
    minus = F.col("strand") == "-"
    a, b = F.when(minus, F.col("g_end")).otherwise(F.col("g_start")), F.when(minus, F.col("g_start")).otherwise(F.col("g_end"))
    has = F.col("gid") % 3 == 0
    i, j = F.when(has, F.col("g_start") + 10).otherwise(F.lit(0)), F.when(has, F.col("g_start") + 20).otherwise(F.lit(0))
    i, j = F.when(minus, j).otherwise(i), F.when(minus, i).otherwise(j)
    note = F.when(F.col("gid") % 7 == 0, " pseudo").otherwise("")
    return genes.select("gid", F.concat(F.format_string("%s \t%d\t%d\t%d\tLeu\tCAA\t%d\t%d\t61.5", "seqid", "gid", a, b, i, j), note).alias("value"))


@query("S17_read_trnascan", "fx_gene", """SELECT seqid, g_start AS start, g_end AS "end", strand, CASE WHEN gid % 3 = 0 THEN g_start + 10 END AS intron_start, CASE WHEN gid % 3 = 0 THEN g_start + 20 END AS intron_end, gid % 7 = 0 AS pseudo FROM fx_gene""")
def s17(genes):
    return parse_trnascan(trna_lines(genes)).select("seqid", "start", "end", "strand", "intron_start", "intron_end", "pseudo")


def trna_features(trnas: DataFrame, prefix: str = "LOC") -> DataFrame:
    """gene, tRNA and exon rows of tRNA genes with a number ``n``; an intron leaves an exon on each side that has bases."""
    row = lambda kind, s, e, own, up: F.struct(F.lit(kind).alias("type"), s.cast("long").alias("start"), e.cast("long").alias("end"), own.alias("id"), up.alias("parent"))
    gene = F.concat(F.lit(f"{prefix}_tRNA_"), padded(F.col("n"), 4))
    rna, none, s, e = F.concat(gene, F.lit("-tRNA")), F.lit(None).cast("string"), F.col("start"), F.col("end")
    split = F.col("intron_start").isNotNull()
    exons = F.when(split, F.array(row("exon", s, F.col("intron_start") - 1, none, rna), row("exon", F.col("intron_end") + 1, e, none, rna))).otherwise(F.array(row("exon", s, e, none, rna)))
    rows = F.concat(F.array(row("gene", s, e, gene, none), row("tRNA", s, e, rna, gene)), F.filter(exons, lambda x: x["start"] <= x["end"]))
    return trnas.select("seqid", "strand", "score", F.explode(rows).alias("x")).select("seqid", "strand", "score", "x.*")


_TRNA = "(SELECT *, concat('LOC_tRNA_', lpad(CAST(gid AS VARCHAR), CAST(greatest(4, length(CAST(gid AS VARCHAR))) AS INTEGER), '0')) AS g FROM fx_gene)"


@query("K09_to_trna_features", "fx_gene", f"""SELECT seqid, 'gene' AS type, g_start AS start, g_end AS "end", g AS id, NULL AS parent FROM {_TRNA} UNION ALL SELECT seqid, 'tRNA', g_start, g_end, concat(g, '-tRNA'), g FROM {_TRNA}
UNION ALL SELECT seqid, 'exon', g_start, CASE WHEN gid % 3 = 0 THEN g_start + 9 ELSE g_end END, NULL, concat(g, '-tRNA') FROM {_TRNA} UNION ALL SELECT seqid, 'exon', g_start + 21, g_end, NULL, concat(g, '-tRNA') FROM {_TRNA} WHERE gid % 3 = 0 AND g_start + 21 <= g_end""")  # fmt: skip
def k09(genes):
    rows = parse_trnascan(trna_lines(genes), ["gid"])
    return trna_features(rows.withColumnRenamed("gid", "n")).select("seqid", "type", "start", "end", "id", "parent")


def parse_busco(rows: DataFrame) -> DataFrame:
    """(busco, seqid, start, end) of complete genes in a full table, with bounds in order."""
    kept = rows.where(~F.trim("value").rlike("^(#|$)") & (_tabs(1) == "Complete"))
    a, b = _tabs(3).try_cast("long"), _tabs(4).try_cast("long")
    return kept.select(*carried(rows), _tabs(0).alias("busco"), _tabs(2).alias("seqid"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end")).where((F.col("seqid") != "") & a.isNotNull() & b.isNotNull() & (F.least(a, b) > 0))


def parse_busco_line(line: Column) -> Column:
    """Percentages and the count of a compact summary such as ``C:98.5%[S:98.0%,D:0.5%],F:0.3%,M:1.2%,n:758``."""
    number = lambda k: F.regexp_extract(line, rf"{k}:([0-9.]+)", 1).try_cast("double").alias({"C": "complete", "S": "single", "D": "duplicated", "F": "fragmented", "M": "missing", "n": "total"}[k])
    return F.struct(*[number(k) for k in "CSDFMn"])


@query("S19_read_busco", "fx_gene", """SELECT CAST(gid AS VARCHAR) AS busco, seqid, g_start AS start, g_end AS "end", n_seg + 0.5 AS complete, CAST(gid AS DOUBLE) AS total FROM fx_gene WHERE gid % 4 < 2""")
def s19(genes):
    status = F.when(F.col("gid") % 4 < 2, "Complete").when(F.col("gid") % 4 == 2, "Duplicated").otherwise("Missing")
    a, b = F.when(F.col("strand") == "-", F.col("g_end")).otherwise(F.col("g_start")), F.when(F.col("strand") == "-", F.col("g_start")).otherwise(F.col("g_end"))
    table = genes.select(F.concat_ws("\t", F.col("gid").cast("string"), status, "seqid", a.cast("string"), b.cast("string"), "strand").alias("value"))
    short = genes.select(F.col("gid").cast("string").alias("busco"), parse_busco_line(F.format_string("C:%d.5%%[S:1.0%%,D:2.0%%],F:3.0%%,M:4.0%%,n:%d", "n_seg", "gid")).alias("s"))
    return parse_busco(table).join(short, "busco").select("busco", "seqid", "start", "end", "s.complete", "s.total")


def check_sheet(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a sample sheet (``n``, ``cells``) with what is wrong with each: ``_error`` is null on good ones.

    ``columns`` is the header.  Columns of no known name are kept in ``extra``.
    """
    double = sorted({c for c in columns if columns.count(c) > 1})
    if double or "sample_id" not in columns:
        raise ValueError(f"sample sheet: {'columns named twice: ' + ', '.join(double) if double else 'no column sample_id'}")
    known = ("sample_id", "fastq_r1", "fastq_r2", "strandedness")
    cell = lambda c: F.nullif(F.trim(F.get("cells", F.lit(columns.index(c)))), F.lit("")) if c in columns else F.lit(None).cast("string")
    extra = [x for c in columns if c not in known for x in (F.lit(c), F.coalesce(cell(c), F.lit("")))]
    keys = carried(rows)
    sheet = rows.select(*keys, "n", *[cell(c).alias(c) for c in known], (F.create_map(*extra) if extra else F.create_map().cast("map<string,string>")).alias("extra"), F.size("cells").alias("_w"))
    seen = F.count("*").over(Window.partitionBy(*keys, "sample_id"))
    bad = (
        F.when(F.col("_w") > len(columns), "more cells than columns").when(F.col("sample_id").isNull(), "no sample_id").when(~F.col("sample_id").rlike(r"^[A-Za-z0-9._-]+$"), "bad character in sample_id")
        .when(F.col("_seen") > 1, "sample_id twice").when(~F.coalesce("strandedness", F.lit("unstranded")).isin("unstranded", "forward", "reverse", "auto"), "unknown strandedness")
    )
    return sheet.withColumn("_seen", seen).withColumn("_error", F.when(bad.isNotNull(), F.concat(F.lit("line "), (F.col("n") + 1).cast("string"), F.lit(": "), bad))).drop("_w", "_seen")


def parse_sheet(rows: DataFrame, header: str) -> DataFrame:
    """A tab-separated sample sheet; blank lines and those with ``#`` are passed over."""
    kept = rows.where(~F.trim("value").rlike("^(#|$)") & (F.col("value") != header))
    return check_sheet(kept.select(*carried(rows), "n", F.split("value", "\t").alias("cells")), header.split("\t"))


@query("S23_read_sample_sheet", "fx_runs", """SELECT sample_id, extra, CASE WHEN pos % 50 = 0 THEN concat('line ', CAST(pos + 1 AS VARCHAR), ': bad character in sample_id') WHEN pos % 31 = 0 THEN concat('line ', CAST(pos + 1 AS VARCHAR), ': more cells than columns')
WHEN pos % 17 = 0 THEN concat('line ', CAST(pos + 1 AS VARCHAR), ': unknown strandedness') END AS error FROM (SELECT pos, concat('s', CAST(pos AS VARCHAR), CASE WHEN pos % 50 = 0 THEN '/x' ELSE '' END) AS sample_id, tool AS extra FROM fx_runs) WHERE NOT (pos % 50 = 0 AND pos % 31 = 0)""")
def s23(runs):
    pos = F.col("pos").cast("string")
    name = F.concat(F.lit("s"), pos, F.when(F.col("pos") % 50 == 0, "/x").otherwise(""))
    line = F.concat(F.concat_ws("\t", name, F.concat(name, F.lit(".fq")), F.when(F.col("pos") % 17 == 0, "sideways").otherwise("forward"), "tool"), F.when(F.col("pos") % 31 == 0, "\tmore").otherwise(""))
    sheet = parse_sheet(runs.where("NOT (pos % 50 = 0 AND pos % 31 = 0)").select(F.col("pos").alias("n"), line.alias("value")), "sample_id\tfastq_r1\tstrandedness\tgroup")
    return sheet.select("sample_id", F.col("extra")["group"].alias("extra"), F.col("_error").alias("error"))


def parse_runs(rows: DataFrame) -> DataFrame:
    """(run, k, url, md5, paired) for each file of a run; runs without files are left out, unpaired lists are an error."""
    urls, sums = _list(_tabs(1), ";"), _list(_tabs(2), ";")
    keys = carried(rows)
    one = rows.select(*keys, _tabs(0).alias("run"), urls.alias("urls"), F.when(F.size(urls) != F.size(sums), F.raise_error(F.concat(F.lit("run with unequal lists: "), _tabs(0))).cast("array<string>")).otherwise(sums).alias("sums"))
    files = one.where(F.size("urls") > 0).select(*keys, "run", (F.size("urls") > 1).alias("paired"), F.posexplode(F.arrays_zip("urls", "sums")).alias("k", "x"))
    return files.select(*keys, "run", "k", F.col("x.urls").alias("url"), F.col("x.sums").alias("md5"), "paired")


@query("S24_read_run_report", "fx_runs", """SELECT concat('R', CAST(pos AS VARCHAR)) AS run, k, concat('ftp/', CAST(pos AS VARCHAR), '_', CAST(k AS VARCHAR)) AS url, concat('m', CAST(k AS VARCHAR)) AS md5, pos % 3 = 2 AS paired
FROM (SELECT pos, unnest(range(0, pos % 3)) AS k FROM fx_runs)""")  # fmt: skip
def s24(runs):
    pos = F.col("pos").cast("string")
    urls = F.when(F.col("pos") % 3 == 0, "").when(F.col("pos") % 3 == 1, F.concat(F.lit("ftp/"), pos, F.lit("_0"))).otherwise(F.concat(F.lit("ftp/"), pos, F.lit("_0;ftp/"), pos, F.lit("_1")))
    sums = F.when(F.col("pos") % 3 == 0, "").when(F.col("pos") % 3 == 1, "m0").otherwise("m0;m1")
    return parse_runs(runs.select(F.concat(F.lit("R"), pos, F.lit("\t"), urls, F.lit("\t"), sums).alias("value"))).withColumn("k", F.col("k").cast("long"))


def missing_levels(sheet: DataFrame, contrasts: DataFrame) -> DataFrame:
    """Contrasts (factor, level) that no sample of the sheet (sample, factor, level) has."""
    return contrasts.join(sheet.where("level IS NOT NULL AND level <> ''").select("factor", "level").distinct(), ["factor", "level"], "left_anti")


@query("J14_samples_with_conditions", "fx_quant", "SELECT 'condition' AS factor, level, level NOT IN (SELECT condition FROM fx_quant) AS missing FROM (VALUES ('control'), ('treated'), ('knockout')) v(level)")
def j14(quant):
    sheet = quant.select("sample", F.lit("condition").alias("factor"), F.col("condition").alias("level"))
    asked = quant.sparkSession.createDataFrame([("condition", x) for x in ("control", "treated", "knockout")], "factor string, level string")
    absent = missing_levels(sheet, asked).withColumn("missing", F.lit(True))
    return asked.join(absent, ["factor", "level"], "left").select("factor", "level", F.coalesce("missing", F.lit(False)).alias("missing"))
