"""Further readers, writers and composite queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.plans.features import _PRIMARY, longest_transcript
from annotspark.plans.formats import parse_quant, quant_lines, spliced
from annotspark.plans.hierarchy import ids
from annotspark.plans.hits import _MERGED, merge_annotations
from annotspark.plans.sequences import protein_sql, translate
from annotspark.registry import query
from annotspark.sources import carried


def _field(k: int, sep: str = "\t") -> Column:
    return F.get(F.split("value", sep), F.lit(k))


def parse_fasta(records: DataFrame, upper: bool = True) -> DataFrame:
    """(id, description, seq) of records cut at ``>``; text before the first header and empty records are dropped.

    Read with ``spark.read.option("lineSep", "\\n>").text``; the first record keeps its mark.
    """
    text = F.regexp_replace("value", "^>", "")
    head = F.substring_index(text, "\n", 1)
    seq = F.regexp_replace(F.expr("substr(regexp_replace(value, '^>', ''), instr(regexp_replace(value, '^>', ''), '\n') + 1)"), r"\s", "")
    rows = records.where(F.contains("value", F.lit("\n")))
    return rows.select(*carried(rows), F.substring_index(head, " ", 1).alias("id"), head.alias("description"), (F.upper(seq) if upper else seq).alias("seq"))


@query("S02_read_fasta", "fx_seq", "SELECT concat('s', CAST(seq_id AS VARCHAR)) AS id, upper(seq) AS seq FROM fx_seq")
def s02(seqs):
    text = F.concat(F.lit(">s"), F.col("seq_id").cast("string"), F.lit(" contig\n"), F.regexp_replace("seq", "(.{60})(?=.)", "$1\n"))
    return parse_fasta(seqs.select(text.alias("value"))).select("id", "seq")


@query("S10_read_snap_gff", "fx_cds", "SELECT CAST(gid AS VARCHAR) AS gene, count(*) AS segments, min(seg_start) AS first_start FROM fx_cds GROUP BY gid")
def s10(segs):
    lines = segs.select(F.col("gid").alias("file"), F.col("ord").alias("file_pos"), F.concat_ws("\t", "seqid", F.lit("SNAP"), F.lit("Exon"), F.col("seg_start").cast("string"), F.col("seg_end").cast("string"), F.lit("."), "strand", F.lit("."), F.col("gid").cast("string")).alias("value"))
    return snap_genes(lines)


def snap_genes(lines: DataFrame) -> DataFrame:
    """A gene begins whenever the name changes from the line before in its file; its row keeps the first segment's start."""
    keys = carried(lines)
    rows = lines.select(*keys, "file", "file_pos", _field(8).alias("gene"), _field(3).try_cast("long").alias("start")).where("start IS NOT NULL")
    w = Window.partitionBy("file").orderBy("file_pos")
    runs = rows.withColumn("_new", F.when(F.lag("gene").over(w).eqNullSafe(F.col("gene")), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    return runs.groupBy(*keys, "file", "_run", "gene").agg(F.count("*").alias("segments"), F.min_by("start", "file_pos").alias("first_start")).select(*keys, "gene", "segments", "first_start")


@query("S11_read_glimmer_gff", "fx_cds", "SELECT seqid, strand, count(*) AS segments, min(seg_start) AS g_start, max(seg_end) AS g_end FROM fx_cds GROUP BY gid, seqid, strand")
def s11(segs):
    gene = segs.groupBy("gid", "seqid", "strand").agg(F.min("seg_start").alias("s"), F.max("seg_end").alias("e")).select(F.col("gid").alias("file"), F.lit(0).alias("file_pos"), "seqid", "strand", F.lit("mRNA").alias("type"), "s", "e")
    cds = segs.select(F.col("gid").alias("file"), F.col("ord").alias("file_pos"), "seqid", "strand", F.lit("CDS").alias("type"), F.col("seg_start").alias("s"), F.col("seg_end").alias("e"))
    return glimmer_genes(gene.unionByName(cds))


def glimmer_genes(rows: DataFrame) -> DataFrame:
    """A gene is the run of CDS rows between mRNA rows of a file."""
    w = Window.partitionBy("file").orderBy("file_pos")
    runs = rows.withColumn("_run", F.sum(F.when(F.col("type") == "mRNA", 1).otherwise(0)).over(w)).where("type <> 'mRNA'")
    return runs.groupBy(*carried(rows), "file", "_run", "seqid", "strand").agg(F.count("*").alias("segments"), F.min("s").alias("g_start"), F.max("e").alias("g_end")).drop("file", "_run")


@query("S15_read_interproscan", "fx_hits", "SELECT query, target AS accession, evalue FROM fx_hits WHERE partkey % 5 <> 0")
def s15(hits):
    status = F.when(F.col("partkey") % 5 == 0, "FALSE").otherwise("T")
    cols = ["query", F.lit("md5"), F.lit("100"), F.lit("Pfam"), "target", F.lit("desc"), F.lit("1"), F.lit("50"), F.col("evalue").cast("string"), status, F.lit("date")]
    return parse_interpro(hits.select(F.concat_ws("\t", *cols).alias("value"))).select("query", "accession", "evalue")


def parse_interpro(rows: DataFrame) -> DataFrame:
    """Domain matches of at least eleven fields that aren't marked FALSE, with their entry and ontology terms where they have any."""
    rows = rows.where((F.size(F.split("value", "\t")) >= 11) & (_field(9) != "FALSE"))
    cell = lambda k: F.nullif(F.nullif(_field(k), F.lit("-")), F.lit(""))
    go = F.regexp_extract_all(F.coalesce(cell(13), F.lit("")), F.lit(r"GO:\d+"), F.lit(0))
    return rows.select(*carried(rows), _field(0).alias("query"), _field(3).alias("library"), _field(4).alias("accession"), _field(8).try_cast("double").alias("evalue"), cell(11).alias("entry"), go.alias("go"))


@query("S18_read_bgc_regions", "fx_gene", "SELECT seqid, g_start AS start, g_end AS \"end\", CASE WHEN gid % 3 = 0 THEN 'unknown' ELSE source END AS kind FROM fx_gene")
def s18(genes):
    attrs = F.when(F.col("gid") % 3 == 0, F.lit("ID=x")).otherwise(F.concat(F.lit("ID=x;Product="), "source"))
    lines = genes.select(F.concat_ws("\t", "seqid", F.lit("a"), F.lit("region"), F.col("g_start").cast("string"), F.col("g_end").cast("string"), F.lit("."), "strand", F.lit("."), attrs).alias("value"))
    return parse_regions(lines).drop("id")


def parse_regions(lines: DataFrame) -> DataFrame:
    """Regions and clusters with their product, else their rules, as ``kind``; without an id the place is one."""
    attr = lambda k: F.nullif(F.regexp_extract(_field(8), f"(?i)(?:^|;)\\s*{k}=([^;]*)", 1), F.lit(""))
    place = F.concat(_field(0), F.lit("_"), _field(3), F.lit("-"), _field(4))
    rows = lines.where(_field(2).isin("region", "cluster"))
    return rows.select(*carried(rows), _field(0).alias("seqid"), _field(3).try_cast("long").alias("start"), _field(4).try_cast("long").alias("end"), F.coalesce(attr("product"), attr("rules"), F.lit("unknown")).alias("kind"), F.coalesce(attr("id"), place).alias("id"))


@query("S21_read_abundance", "fx_quant", "SELECT transcript, sample, num_reads AS est_counts, round(tpm, 6) AS tpm FROM fx_quant")
def s21(quant):
    """By the names of the columns, wherever they stand."""
    lines = quant_lines(quant, ["tpm", "length", "target_id", "eff_length", "est_counts"], [F.col("tpm").cast("string"), F.lit("1000"), F.col("transcript"), F.lit("900"), F.col("num_reads").cast("string")])
    found = parse_quant(lines, {"target_id": "transcript", "est_counts": "est_counts", "tpm": "tpm"}, "target_id")
    return found.select("transcript", "sample", "est_counts", F.round("tpm", 6).alias("tpm"))


@query("S25_read_topology_calls", "fx_hits", "SELECT query, CAST(min(partkey % 4) AS BIGINT) AS tm, bool_or(partkey % 2 = 0) AS signal FROM fx_hits GROUP BY query")
def s25(hits):
    line = F.concat_ws(" ", "query", (F.col("partkey") % 4).cast("string"), F.when(F.col("partkey") % 2 == 0, "Y").otherwise("0"), F.lit("o"))
    rows = parse_topology(hits.select(line.alias("value")))
    return rows.groupBy("query").agg(F.min("tm").alias("tm"), F.max("signal").alias("signal"))


def parse_topology(rows: DataFrame) -> DataFrame:
    """(query, tm, signal): transmembrane helices and whether a signal peptide is called, in blank-separated rows."""
    p = lambda k: F.get(F.split(F.trim("value"), r"\s+"), F.lit(k))
    rows = rows.where(~F.trim("value").rlike("^(#|$|SEQENCE|SEQUENCE|ID )"))
    return rows.select(*carried(rows), p(0).alias("query"), p(1).try_cast("long").alias("tm"), (p(2) == "Y").alias("signal"))


@query("S26_read_sam_extents", "fx_paf", "SELECT qname AS name, min(q_start) AS x_start, max(q_start + matches) AS x_end FROM fx_paf GROUP BY qname")
def s26(paf):
    cols = ["qname", F.lit("0"), "tname", F.col("q_start").cast("string"), F.lit("60"), F.concat(F.col("matches").cast("string"), F.lit("M3S")), F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("IIII")]
    rows = parse_sam(paf.select(F.concat_ws("\t", *cols).alias("value")))
    return rows.groupBy("name").agg(F.min("x_start").cast("int").alias("x_start"), F.max("x_end").alias("x_end"))


def parse_sam(rows: DataFrame) -> DataFrame:
    """(name, seqid, x_start, x_end) of mapped reads: where they begin, and that plus the reference bases of their CIGAR."""
    from annotspark.plans.formats import cigar_length

    rows = rows.where(~F.col("value").startswith("@") & (F.size(F.split("value", "\t")) >= 10) & (_field(5) != "*"))
    at = _field(3).try_cast("long")
    return rows.select(*carried(rows), _field(0).alias("name"), _field(2).alias("seqid"), at.alias("x_start"), (at + cigar_length(_field(5))).alias("x_end")).where("x_start IS NOT NULL")


@query("S27_read_name_map", "fx_hits", "SELECT DISTINCT query AS id, target AS name FROM fx_hits")
def s27(hits):
    lines = hits.select(F.concat_ws("\t", "query", "target").alias("value")).union(hits.sparkSession.createDataFrame([("# names",)], "value string"))
    return parse_names(lines)


def parse_names(lines: DataFrame) -> DataFrame:
    """(id, name) of two-column tables, each pair once."""
    rows = lines.where(~F.col("value").startswith("#") & (F.size(F.split("value", "\t")) >= 2))
    return rows.select(*carried(rows), _field(0).alias("id"), _field(1).alias("name")).distinct()


@query("S28_read_metrics_json", "fx_runs", "SELECT genome, tool, metric AS f1, 0.0 AS seconds FROM fx_runs")
def s28(runs):
    text = F.to_json(F.struct("genome", "tool", F.struct(F.col("metric").alias("f1")).alias("scores")))
    return parse_metrics(runs.select(text.alias("value"))).withColumn("genome", F.col("genome").cast("long"))


def parse_metrics(rows: DataFrame) -> DataFrame:
    """(genome, tool, f1, seconds) of one JSON text a row; missing numbers are 0."""
    row = F.from_json("value", "genome string, tool string, scores struct<f1 double>, performance struct<seconds double>")
    return rows.select(*carried(rows), row.alias("r")).select(*carried(rows), "r.genome", "r.tool", F.coalesce("r.scores.f1", F.lit(0.0)).alias("f1"), F.coalesce("r.performance.seconds", F.lit(0.0)).alias("seconds"))


@query("P16_gtf_attribute", "fx_cds", "SELECT gid, ord, CASE WHEN gid % 2 = 0 THEN concat('t', gid) ELSE concat('p', gid) END AS transcript FROM fx_cds")
def p16(segs):
    g = F.col("gid").cast("string")
    attrs = F.when(F.col("gid") % 2 == 0, F.concat(F.lit('gene_id "x"; transcript_id "t'), g, F.lit('";'))).otherwise(F.concat(F.lit("ID=c;Parent=p"), g))
    return segs.select("gid", "ord", transcript_key(attrs).alias("transcript"))


def transcript_key(attrs: Column) -> Column:
    """Quoted transcript_id, else Parent, else ID, else the bare text."""
    found = [F.nullif(F.regexp_extract(attrs, p, 1), F.lit("")) for p in ('transcript_id "([^"]*)"', "Parent=([^;]*)", "ID=([^;]*)")]
    return F.coalesce(*found, F.trim(attrs))


@query("P20_mapping_rate_extract", "fx_runs", "SELECT genome, round(min_by(metric, pos) / 100, 6) AS rate FROM fx_runs GROUP BY genome")
def p20(runs):
    line = F.concat(F.lit("[info] Mapping rate = "), F.col("metric").cast("string"), F.lit("%"))
    rate = F.regexp_extract(line, r"Mapping rate = ([0-9.E-]+)%", 1).try_cast("double") / 100
    return runs.select("genome", "pos", rate.alias("rate")).groupBy("genome").agg(F.round(F.min_by("rate", "pos"), 6).alias("rate"))


@query("P18_kingdom_clade_lookup", "fx_ortho", "SELECT DISTINCT genome, CASE genome WHEN 'G0' THEN 'saccharomyces' WHEN 'G1' THEN 'aspergillus' ELSE 'generic' END AS model FROM fx_ortho")
def p18(ortho):
    clades = ortho.sparkSession.createDataFrame([("G0", "saccharomyces"), ("G1", "aspergillus")], "genome string, model string")
    return ortho.select("genome").distinct().join(F.broadcast(clades), "genome", "left").select("genome", F.coalesce("model", F.lit("generic")).alias("model"))


@query("K02_to_gtf", "fx_feature", """SELECT f.id, CASE f.type WHEN 'mRNA' THEN 'transcript' ELSE f.type END AS type, concat('gene_id "', coalesce(m.parent, f.parent, f.id), '"; transcript_id "', coalesce(CASE WHEN f.type = 'mRNA' THEN f.id END, f.parent, f.id), '";') AS attrs
FROM fx_feature f LEFT JOIN (SELECT id, min(parent) AS parent FROM fx_feature GROUP BY id) m ON m.id = f.parent""")  # fmt: skip
def k02(features):
    up = ids(features).select(F.col("id").alias("_p"), F.col("parent").alias("_g"))
    rows = features.join(up, features["parent"] == up["_p"], "left")
    gene = F.coalesce("_g", "parent", "id")
    tx = F.coalesce(F.when(F.col("type") == "mRNA", F.col("id")), "parent", "id")
    kind = F.when(F.col("type") == "mRNA", "transcript").otherwise(F.col("type"))
    return rows.select("id", kind.alias("type"), F.concat(F.lit('gene_id "'), gene, F.lit('"; transcript_id "'), tx, F.lit('";')).alias("attrs"))


@query("J11_annotation_table", "fx_gene fx_hits", f"SELECT locus, product, coalesce(printf('%.1f', identity), '') AS identity, coalesce(printf('%.2e', evalue), '') AS evalue FROM ({_MERGED})")
def j11(genes, hits):
    rows = merge_annotations(genes, hits)
    shown = lambda f, c: F.when(F.col(c).isNotNull(), F.format_string(f, c)).otherwise("").alias(c)
    return rows.select("locus", "product", shown("%.1f", "identity"), shown("%.2e", "evalue"))


@query("C10_functional_annotation", "fx_gene fx_hits fx_go", f"""WITH t AS (SELECT locus, string_agg(DISTINCT go, '|' ORDER BY go) AS terms FROM (SELECT concat('LT', CAST(g.gid AS VARCHAR)) AS locus, t.go FROM fx_gene g
JOIN fx_hits h ON h.query = concat('LT', CAST(g.gid AS VARCHAR)) JOIN fx_go t ON t.gene = 'tx' || substr(h.target, 2)) GROUP BY locus) SELECT m.*, t.terms FROM ({_MERGED}) m LEFT JOIN t ON t.locus = m.locus""")  # fmt: skip
def c10(genes, hits, go):
    from annotspark.plans.hits import j09

    return merge_annotations(genes, hits).join(j09(genes, hits, go), "locus", "left")


@query("J06_primary_protein", "fx_feature fx_ctg", f"""WITH c AS (SELECT p.id, f.strand, string_agg(substr(seq, f.f_start, f.f_end - f.f_start + 1), '' ORDER BY f.f_start, f.f_end) AS s
FROM ({_PRIMARY}) p JOIN (SELECT * FROM fx_feature WHERE type = 'CDS') f ON f.parent = p.id JOIN fx_ctg ON f.seqid = fx_ctg.seqid GROUP BY p.id, f.strand),
t AS (SELECT id, {protein_sql("CASE WHEN strand = '-' THEN reverse(translate(s, 'ACGTacgtUu', 'TGCAtgcaAa')) ELSE s END")} AS protein FROM c)
SELECT id, protein FROM t WHERE length(protein) >= 10 AND NOT contains(protein, '*')""")  # fmt: skip
def j06(features, contigs):
    """The protein of the longest transcript of each gene, from that transcript's CDS: at least 10 letters, no internal stop."""
    primary = longest_transcript(features).select("id")
    segs = features.where("type = 'CDS'").select("seqid", "strand", F.col("parent").alias("id"), F.col("f_start").alias("seg_start"), F.col("f_end").alias("seg_end"))
    proteins = spliced(segs.join(primary, "id", "left_semi"), contigs, "id").select("id", translate(F.col("cds")).alias("protein"))
    return proteins.where((F.length("protein") >= 10) & ~F.contains("protein", F.lit("*")))


@query("I04_softmask_runs", "fx_seq", "SELECT seq_id, count(*) AS runs, CAST(sum(length(r)) AS BIGINT) AS bases, max(length(r)) AS longest FROM (SELECT seq_id, unnest(regexp_extract_all(seq, '[a-z]+')) AS r FROM fx_seq) GROUP BY seq_id")
def i04(seqs):
    runs = softmask_runs(seqs, "seq_id", "seq").withColumn("n", F.col("end") - F.col("start") + 1)
    return runs.groupBy("seq_id").agg(F.count("*").alias("runs"), F.sum("n").alias("bases"), F.max("n").alias("longest"))


def softmask_runs(seqs: DataFrame, key: str, seq: str) -> DataFrame:
    """Maximal lower-case runs as 1-based inclusive intervals."""
    parts = F.regexp_extract_all(seq, F.lit("[a-z]+|[^a-z]+"), F.lit(0))
    rows = seqs.select(key, F.posexplode(parts).alias("k", "part"))
    w = Window.partitionBy(key).orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = rows.withColumn("end", F.sum(F.length("part").cast("long")).over(w)).where("part RLIKE '^[a-z]'")
    return ends.select(key, (F.col("end") - F.length("part") + 1).alias("start"), "end")


@query("A13_completeness_summary", "fx_ortho", "SELECT genome, count(*) FILTER (WHERE n = 1) AS single, count(*) FILTER (WHERE n > 1) AS duplicated, round(100.0 * count(*) / (SELECT count(DISTINCT og) FROM fx_ortho), 6) AS percent FROM (SELECT genome, og, count(*) AS n FROM fx_ortho GROUP BY 1, 2) GROUP BY genome")
def a13(ortho):
    total = ortho.agg(F.count_distinct("og").alias("total"))
    per = ortho.groupBy("genome", "og").agg(F.count("*").alias("n")).groupBy("genome").agg(F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("duplicated"))
    return per.crossJoin(total).select("genome", "single", "duplicated", F.round(100.0 * (F.col("single") + F.col("duplicated")) / F.col("total"), 6).alias("percent"))
