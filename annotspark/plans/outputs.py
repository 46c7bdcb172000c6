"""Tables and sequences that go out: locations, variant tables, consensus and personal sequences, decorated features, manifests."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annotspark.fixtures import TABLES
from annotspark.operators import graph
from annotspark.operators import intervals as iv
from annotspark.operators.names import unique_names
from annotspark.plans.evaluation import KEYS, models
from annotspark.plans.formats import spliced
from annotspark.plans.hits import _MERGED, merge_annotations
from annotspark.plans.sequences import reverse_complement
from annotspark.registry import QUERIES, query
from annotspark.sources.digests import digests
from annotspark.tables import let, written


def feature_locations(segs: DataFrame) -> DataFrame:
    """(gid, location, codon_start): a transcript's segments in its own order, bounds swapped on the minus strand, ``phase`` of the first."""
    minus = F.col("strand") == "-"
    order = F.when(minus, -F.col("seg_end")).otherwise(F.col("seg_start"))
    one = segs.groupBy("gid", "strand").agg(F.sort_array(F.collect_list(F.struct(order.alias("o"), "seg_start", "seg_end", "phase"))).alias("s"))
    line = lambda x: F.concat_ws("\t", F.when(minus, x["seg_end"]).otherwise(x["seg_start"]).cast("string"), F.when(minus, x["seg_start"]).otherwise(x["seg_end"]).cast("string"))
    return one.select("gid", F.array_join(F.transform("s", line), "\n").alias("location"), (F.coalesce(F.get("s", F.lit(0))["phase"], F.lit(0)) + 1).alias("codon_start"))


@query("K07_to_feature_locations", "fx_cds", """SELECT gid, string_agg(CASE WHEN strand = '-' THEN concat(seg_end, chr(9), seg_start) ELSE concat(seg_start, chr(9), seg_end) END, chr(10) ORDER BY CASE WHEN strand = '-' THEN -seg_end ELSE seg_start END, seg_start) AS location,
CAST(1 + arg_min(ord % 3, CASE WHEN strand = '-' THEN -seg_end * 100000 + seg_start ELSE seg_start * 100000 + seg_end END) AS INTEGER) AS codon_start FROM fx_cds GROUP BY gid""")  # fmt: skip
def k07(segs):
    return feature_locations(segs.withColumn("phase", (F.col("ord") % 3).cast("int")))


def info_map(info: Column) -> Column:
    """The key=value pairs of an INFO cell, the last of a key; flags without a value are left out."""
    pairs = F.reverse(F.filter(F.split(info, ";"), lambda x: F.contains(x, F.lit("="))))
    parts = let(pairs, lambda ps: F.struct(F.transform(ps, lambda x: F.substring_index(x, "=", 1)).alias("k"), F.transform(ps, lambda x: F.substring(x, F.instr(x, "=") + 1, F.length(x))).alias("v")))
    return let(parts, lambda s: let(F.array_distinct(s["k"]), lambda ks: F.map_from_arrays(ks, F.transform(ks, lambda k: F.element_at(s["v"], F.array_position(s["k"], k).cast("int"))))))


def variant_table(lines: DataFrame, keys: list[str]) -> DataFrame:
    """One row per variant and one column per INFO key; what is missing is a dot, qualities have two decimals."""
    p = F.split("value", "\t")
    at = lambda k: F.get(p, F.lit(k))
    rows = lines.where(~F.col("value").startswith("#") & (F.size(p) >= 8) & at(1).try_cast("long").isNotNull())
    qual = F.coalesce(F.format_string("%.2f", at(5).try_cast("double")), F.lit("."))
    rows = rows.select(at(0).alias("chrom"), at(1).try_cast("long").alias("pos"), at(2).alias("id"), at(3).alias("ref"), at(4).alias("alt"), F.when(at(5).try_cast("double").isNull(), ".").otherwise(qual).alias("qual"), at(6).alias("filter"), info_map(at(7)).alias("_info"))
    return rows.select("*", *[F.coalesce(F.try_element_at("_info", F.lit(k)), F.lit(".")).alias(k) for k in keys]).drop("_info")


def info_keys(lines: DataFrame) -> list[str]:
    """Keys that the header declares, in its order; as many as a header has lines."""
    found = lines.where(F.col("value").startswith("##INFO=<ID=")).select(F.regexp_extract("value", "ID=([^,>]*)", 1)).collect()
    return list(dict.fromkeys(r[0] for r in found))


@query("K11_vcf_to_table", "fx_vcf", """SELECT chrom, CAST(pos AS BIGINT) AS pos, CAST(event_id AS VARCHAR) AS id, ref, alt, CASE WHEN event_id % 4 = 0 THEN '.' ELSE concat(CAST(event_id % 100 AS VARCHAR), '.50') END AS qual, filter_tag AS filter,
CAST(event_id % 60 AS VARCHAR) AS DP, CASE WHEN event_id % 3 = 0 THEN '.' ELSE concat('0.', CAST(event_id % 10 AS VARCHAR)) END AS AF FROM fx_vcf""")  # fmt: skip
def k11(variants):
    n = lambda k: (F.col("event_id") % k).cast("string")
    info = F.concat(F.lit("DP=1;DB;DP="), n(60), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit(";AF=0."), n(10))))
    qual = F.when(F.col("event_id") % 4 == 0, ".").otherwise(F.concat(n(100), F.lit(".5")))
    lines = variants.select(F.concat_ws("\t", "chrom", F.col("pos").cast("string"), F.col("event_id").cast("string"), "ref", "alt", qual, "filter_tag", info).alias("value"))
    return variant_table(lines, ["DP", "AF"])


def variant_consensus(contigs: DataFrame, variants: DataFrame) -> DataFrame:
    """(seqid, seq): contigs with every first alternative put in, from the highest place down; of one place the last listed goes first.

    Variants have chrom, pos, ref, alt and their ``line``; those that end behind the contig as it then is are left out.
    """
    real = variants.where("alt <> '.' AND alt <> ref").groupBy(F.col("chrom").alias("seqid")).agg(F.sort_array(F.collect_list(F.struct("pos", "line", F.length("ref").alias("n"), F.upper("alt").alias("alt"))), asc=False).alias("edits"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for seq, edits in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = bytearray(seq.encode())
                for e in edits or ():
                    at = e["pos"] - 1
                    if at >= 0 and at + e["n"] <= len(text):
                        text[at : at + e["n"]] = e["alt"].encode()
                out.append(text.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["seqid", "seq"])

    # edits are hashed: sorting would move every whole contig once more
    return contigs.select("seqid", "seq").join(real.hint("shuffle_hash"), "seqid", "left").select("seqid", "seq", "edits").mapInArrow(run, "seqid string, seq string")


def _plain_variants(variants: DataFrame) -> DataFrame:
    return variants.select("chrom", "pos", "ref", F.get(F.split("alt", ","), F.lit(0)).alias("alt"), F.col("event_id").alias("line")).where("alt RLIKE '^[ACGT]+$'")


@query("K14_vcf_to_consensus", "fx_ctg fx_vcf")
def k14(contigs, variants):
    done = variant_consensus(contigs, _plain_variants(variants))
    return done.select("seqid", F.length("seq").alias("bases"), F.md5("seq").alias("digest"))


#: Fixed clans of peptidase families, by first letter.
CLANS = {"S": "PA", "C": "CA", "A": "AA", "M": "MA", "T": "PB", "G": "GC", "N": "PD", "I": "IA"}


def peptidase_fields(name: Column, title: Column) -> Column:
    """(merops_id, family, clan, name, organism, inhibitor) of a peptidase's id and title."""
    trimmed = lambda t: F.transform(F.split(t, r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{Alnum}.]+|[^\p{Alnum}.]+$", ""))
    code = lambda t: F.get(F.filter(trimmed(t), lambda w: w.rlike(r"^[A-Z][0-9]{2}") & F.contains(w, F.lit("."))), F.lit(0))
    found = F.coalesce(code(name), code(title), name)
    family = F.substring(found, 1, 1)
    clan = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in CLANS.items() for x in p]), family), F.lit(""))
    second = F.trim(F.substring_index(F.get(F.split(title, " - "), F.lit(1)), "(", 1))
    label = F.when(F.coalesce(second, F.lit("")) != "", second).otherwise(F.trim(F.substring_index(title, " - ", 1)))
    left, right = F.instr(title, "("), F.instr(title, ")")
    organism = F.when((left > 0) & (right > left), F.substring(title, left + 1, right - left - 1)).otherwise("")
    return F.struct(found.alias("merops_id"), family.alias("family"), clan.alias("clan"), label.alias("name"), organism.alias("organism"), (family == "I").alias("inhibitor"))


@query("P12_parse_title_fields", "fx_hits", """SELECT target, concat(l, CASE WHEN k % 2 = 0 THEN '08' ELSE '11' END, '.00', CAST(k % 7 AS VARCHAR)) AS merops_id, l AS family, CASE l WHEN 'S' THEN 'PA' WHEN 'A' THEN 'AA' WHEN 'I' THEN 'IA' ELSE '' END AS clan,
CASE WHEN k % 5 = 0 THEN concat('MER', target) ELSE concat('Subtilisin ', target) END AS name, CASE WHEN k % 3 = 0 THEN '' ELSE 'Bacillus sp.' END AS organism, l = 'I' AS inhibitor
FROM (SELECT DISTINCT target, partkey AS k, substr('SAIX', CAST(partkey % 4 AS INTEGER) + 1, 1) AS l FROM fx_hits)""")  # fmt: skip
def p12(hits):
    k = F.col("partkey")
    code = F.concat(F.substring(F.lit("SAIX"), (k % 4).cast("int") + 1, F.lit(1)), F.when(k % 2 == 0, "08").otherwise("11"), F.lit(".00"), (k % 7).cast("string"))
    middle = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("Subtilisin "), "target"))
    title = F.concat(F.lit("MER"), "target", F.lit(" - "), middle, F.when(k % 3 == 0, "").otherwise(" (Bacillus sp.)"), F.lit(" - ["), code, F.lit("]"))
    return hits.select("target", "partkey").distinct().select("target", peptidase_fields(F.lit("MER1"), title).alias("x")).select("target", "x.*")


def decorated(features: DataFrame, found: DataFrame) -> DataFrame:
    """Features with product, dbxref, ontology and note on the gene rows whose tag, else id, an annotation has."""
    named = found.select(F.col("locus").alias("_k"), "product", "dbxref", "ontology", "note")
    rows = features.withColumn("_t", F.when(F.col("type") == "gene", F.coalesce("locus_tag", "id")))
    return rows.join(named, rows["_t"] == named["_k"], "left").drop("_t", "_k")


@query("J10_decorate_features", "fx_feature fx_gene fx_hits", f"""WITH m AS ({_MERGED}), d AS (SELECT query, 'InterPro:' || string_agg(DISTINCT target, ',InterPro:' ORDER BY target) AS x, 'Pfam:' || string_agg(DISTINCT target, ',' ORDER BY target) AS n FROM fx_hits WHERE source = 'domain' GROUP BY query)
SELECT f.id, f.type, f.f_start, m.product, d.x AS dbxref, d.n AS note FROM fx_feature f LEFT JOIN m ON f.type = 'gene' AND m.locus = coalesce(f.locus_tag, f.id) LEFT JOIN d ON m.locus = d.query""")  # fmt: skip
def j10(features, genes, hits):
    names = hits.where("source = 'domain'").groupBy(F.col("query").alias("locus")).agg(F.sort_array(F.collect_set("target")).alias("t"))
    found = merge_annotations(genes, hits).select("locus", "product").join(names, "locus", "left")
    found = found.withColumn("dbxref", F.array_join(F.transform("t", lambda x: F.concat(F.lit("InterPro:"), x)), ",")).withColumn("note", F.concat(F.lit("Pfam:"), F.array_join("t", ","))).withColumn("ontology", F.lit(None).cast("string"))
    return decorated(features, found).select("id", "type", "f_start", "product", "dbxref", "note")


def merge_remote(topology: DataFrame, entries: DataFrame, places: DataFrame) -> DataFrame:
    """One row per protein of any of three tables: signal (Y, N or empty), helices, accessions, terms, place."""
    per = entries.groupBy("gene").agg(F.array_join(F.sort_array(F.collect_set("ipr")), "|").alias("ipr_accessions"), F.array_join(F.sort_array(F.collect_set("go")), "|").alias("go_terms"))
    rows = topology.join(per, "gene", "full").join(places, "gene", "full")
    text = lambda c: F.coalesce(c, F.lit(""))
    return rows.select("gene", text(F.when(F.col("signal"), "Y").when(~F.col("signal"), "N")).alias("signal_peptide"), text(F.col("helices").cast("string")).alias("tm_count"), text(F.col("ipr_accessions")).alias("ipr_accessions"), text(F.col("go_terms")).alias("go_terms"), text(F.col("place")).alias("localisation"))


@query("C12_remote_annotations_merge", "fx_hits", """WITH t AS (SELECT query AS gene, max(evalue) < 0.004 AS s, count(*) AS n FROM fx_hits WHERE source = 'homology' GROUP BY 1), e AS (SELECT query AS gene, string_agg(DISTINCT concat('IPR', target), '|' ORDER BY concat('IPR', target)) AS i,
string_agg(DISTINCT concat('GO:', dom_len), '|' ORDER BY concat('GO:', dom_len)) AS g FROM fx_hits WHERE source = 'domain' GROUP BY 1), p AS (SELECT query AS gene, min(target) AS l FROM fx_hits WHERE source = 'family' GROUP BY 1)
SELECT gene, CASE WHEN s THEN 'Y' WHEN NOT s THEN 'N' ELSE '' END AS signal_peptide, coalesce(CAST(n AS VARCHAR), '') AS tm_count, coalesce(i, '') AS ipr_accessions, coalesce(g, '') AS go_terms, coalesce(l, '') AS localisation FROM t FULL JOIN e USING (gene) FULL JOIN p USING (gene)""")
def c12(hits):
    own = lambda s: hits.where(F.col("source") == s).withColumnRenamed("query", "gene")
    topology = own("homology").groupBy("gene").agg((F.max("evalue") < 0.004).alias("signal"), F.count("*").alias("helices"))
    entries = own("domain").select("gene", F.concat(F.lit("IPR"), "target").alias("ipr"), F.concat(F.lit("GO:"), F.col("dom_len").cast("string")).alias("go"))
    return merge_remote(topology, entries, own("family").groupBy("gene").agg(F.min("target").alias("place")))


def repair_qualifiers(rows: DataFrame) -> DataFrame:
    """Qualifiers (record, feature, kind, n, key, value) with ``fix``: what was done to each, null where nothing was.

    Of equal locus tags the second and further ones (by record, feature and place) get the least number that makes them a
    tag of their own; a codon start beyond 1 to 3 becomes 1; stars leave translations; coding features without a product
    are given one.  Only locus tags are numbered: what many features share, such as a product, meets nowhere.
    """
    named = F.coalesce(F.col("key") == "locus_tag", F.lit(False))
    tags = written(rows.where(named).withColumn("_was", F.col("value")), "tags")
    tags = unique_names(tags, "value", [F.asc("record"), F.asc("feature"), F.asc("n")], mark="_")
    tags = tags.withColumn("fix", F.when(F.col("value") != F.col("_was"), "duplicate_tag")).drop("_was")
    start, protein = F.col("key") == "codon_start", F.col("key") == "translation"
    wrong = start & ~F.col("value").isin("1", "2", "3")
    fix = F.when(wrong, "codon_start").when(protein & F.contains("value", F.lit("*")), "stops")
    new = F.when(wrong, "1").when(protein, F.replace("value", F.lit("*"), F.lit(""))).otherwise(F.col("value"))
    out = rows.where(~named).withColumn("fix", fix).withColumn("value", new).unionByName(tags)
    coding = rows.where("kind = 'CDS'").groupBy("record", "feature", "kind").agg(F.max("n").alias("n"), F.max(F.col("key") == "product").alias("_has")).where("NOT _has")
    added = coding.select("record", "feature", "kind", (F.col("n") + 1).alias("n"), F.lit("product").alias("key"), F.lit("hypothetical protein").alias("value"), F.lit("missing_product").alias("fix"))
    return out.select(*added.columns).unionByName(added)


@query("V11_repair_qualifiers", "fx_gene", """SELECT CASE WHEN gid % 5 = 0 AND r > 1 THEN 'duplicate_tag' END AS fix, count(*) AS n FROM (SELECT gid, row_number() OVER (PARTITION BY CASE WHEN gid % 5 = 0 THEN seqid ELSE CAST(gid AS VARCHAR) END ORDER BY gid) AS r FROM fx_gene) GROUP BY 1
UNION ALL SELECT CASE WHEN gid % 7 > 2 THEN 'codon_start' END, count(*) FROM fx_gene GROUP BY 1 UNION ALL SELECT CASE WHEN gid % 3 = 0 THEN 'stops' END, count(*) FROM fx_gene GROUP BY 1
UNION ALL SELECT CASE WHEN gid % 4 = 0 THEN 'missing_product' END, count(*) FROM fx_gene GROUP BY 1""")  # fmt: skip
def v11(genes):
    gid, k = F.col("gid").cast("string"), F.col("gid")
    own = lambda n, key, value: F.struct(F.lit(n).alias("n"), F.lit(key).alias("key"), value.alias("value"))
    cells = F.array(
        own(1, "locus_tag", F.when(k % 5 == 0, F.col("seqid")).otherwise(gid)), own(2, "codon_start", (k % 7 + 1).cast("string")),
        own(3, "translation", F.when(k % 3 == 0, "MK*LV*").otherwise("MKLV")), F.when(k % 4 != 0, own(4, "product", F.lit("kinase"))),
    )
    rows = genes.select("seqid", "gid", F.explode(F.array_compact(cells)).alias("x")).select(F.col("seqid").alias("record"), F.col("gid").alias("feature"), F.lit("CDS").alias("kind"), "x.*")
    return repair_qualifiers(rows).groupBy("key", "fix").agg(F.count("*").alias("n")).select("fix", "n")


def file_manifest(spark, path: str, tables: list[str]) -> DataFrame:
    """(file, bytes, md5, sha256, rows) of the Parquet files of named tables, which are told apart by their whole path."""
    count = None
    for t in tables:
        one = spark.read.parquet(f"{path}/{t}.parquet").select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count("*").alias("rows"))
        count = one if count is None else count.unionByName(one)
    files = digests(spark, [f"{path}/{t}.parquet" for t in tables]).join(count, "path", "left")
    return files.select(F.col("name").alias("file"), "bytes", "md5", "sha256", F.coalesce("rows", F.lit(0)).alias("rows"))


#: All of the driver's tables.
MANIFEST = sorted(TABLES | {"region", "nation", "embeddings", "pages", "labels"})
QUERIES["B03_file_manifest"] = lambda spark, sf_dir: file_manifest(spark, sf_dir, MANIFEST)


def cache_key(coding: Column, genome: Column, version: str, k: int) -> Column:
    """The key under which an index of two files, given by their digests, is kept."""
    return F.sha2(F.concat_ws("|", coding, genome, F.lit(version), F.lit(str(k))), 256)


@query("B04_index_cache_key", "fx_seq", "SELECT seq_id, sha256(concat(sha256(seq), '|', sha256(upper(seq)), '|1.10.3|31')) AS key FROM fx_seq")
def b04(seqs):
    return seqs.select("seq_id", cache_key(F.sha2("seq", 256), F.sha2(F.upper("seq"), 256), "1.10.3", 31).alias("key"))


def error_taxonomy(pred: DataFrame, ref: DataFrame) -> DataFrame:
    """(category, n, n_pred, n_ref): groups of predictions and references that overlap on their strand, by how many of each.

    One of each is exact or has wrong boundaries; one over several is merged, several over one are split, several over
    several tangled; extra predictions and missed references meet none.
    """
    # several steps read them; nodes of predictions are even numbers, those of references odd ones
    p, r = written(models(pred, "gid", "g"), "predictions"), written(models(ref, "rid", "r"), "references")
    met = iv.overlap_join(p, r, KEYS, "g_start", "g_end", "r_start", "r_end")
    met = written(met.select("gid", "rid", (F.col("gid") * 2).alias("a"), (F.col("rid") * 2 + 1).alias("b"), (F.col("g_key") == F.col("r_key")).alias("same")), "met")
    groups = written(graph.components(met, "a", "b"), "groups")
    odd = F.pmod(F.col("node"), F.lit(2)) == 1
    own = groups.groupBy("component").agg(F.count_if(~odd).alias("p"), F.count_if(odd).alias("r"))
    same = met.where("same").join(groups, met["a"] == groups["node"]).select("component").distinct().withColumn("same", F.lit(True))
    own = own.join(same, "component", "left")
    kind = (
        F.when((F.col("p") == 1) & (F.col("r") == 1), F.when(F.col("same"), "exact").otherwise("wrong_boundaries")).when(F.col("p") == 1, "merged").when(F.col("r") == 1, "split").otherwise("tangled")
    )
    counted = own.groupBy(kind.alias("category")).agg(F.count("*").alias("n"), F.sum("p").alias("n_pred"), F.sum("r").alias("n_ref"))
    alone = lambda all_, id_, name, a, b: all_.select(id_).join(met.select(id_), id_, "left_anti").agg(F.count("*").alias("n")).select(F.lit(name).alias("category"), "n", a.alias("n_pred"), b.alias("n_ref"))
    none, n = F.lit(0).cast("long"), F.col("n")
    return counted.unionByName(alone(p, "gid", "extra", n, none)).unionByName(alone(r, "rid", "missed", none, n))


@query("E05_error_taxonomy", "fx_cds fx_ref")
def e05(pred, ref):
    return error_taxonomy(pred, ref)


def personal_sequences(segs: DataFrame, contigs: DataFrame, variants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Coding sequences of both haplotypes with their variants put in, and what became of each variant.

    Variants have event_id, chrom, pos, ref and the alleles ``hap0`` and ``hap1``.  A variant is placed in every
    transcript that holds its first base.  It is skipped where its last base lies in no segment of that transcript
    (spans_exon_boundary), where another one of the transcript and haplotype overlaps it (in_cis_overlap, all of them
    then) or the transcript has other bases there (ref_mismatch).
    """
    placed = iv.transcript_offset(segs.select("gid", "seqid", "strand", "seg_start", "seg_end"), "gid", "strand", "seg_start", "seg_end")
    alleles = variants.select("event_id", F.col("chrom").alias("seqid"), "pos", "ref", F.explode(F.array(*[F.struct(F.lit(h).alias("hap"), F.col(h).alias("alt")) for h in ("hap0", "hap1")])).alias("x"))
    alleles = alleles.select("event_id", "seqid", "pos", "ref", "x.*").where("alt <> ref").withColumn("last", F.col("pos") + F.length("ref") - 1).withColumn("pos_end", F.col("pos"))
    met = iv.overlap_join(alleles, placed, ["seqid"], "pos", "pos_end", "seg_start", "seg_end")
    to = lambda at: F.when(F.col("strand") == "-", F.col("offset") + F.col("seg_end") - F.col(at)).otherwise(F.col("offset") + F.col(at) - F.col("seg_start"))
    first = met.withColumn("c1", to("pos")).select("event_id", "hap", "gid", "strand", "ref", "alt", "last", "c1")
    ends = placed.select("gid", F.col("seg_start").alias("_s"), F.col("seg_end").alias("_e"), F.col("offset").alias("_o"))
    inside = (F.col("last") >= F.col("_s")) & (F.col("last") <= F.col("_e"))
    c2 = F.when(F.col("strand") == "-", F.col("_o") + F.col("_e") - F.col("last")).otherwise(F.col("_o") + F.col("last") - F.col("_s"))
    keys = ["event_id", "hap", "gid", "strand", "ref", "alt", "last", "c1"]
    both = first.join(ends, "gid").groupBy(*keys).agg(F.min(F.when(inside, c2)).alias("c2"))
    both = both.withColumn("lo", F.least("c1", "c2")).withColumn("hi", F.greatest("c1", "c2")).withColumn("reason", F.when(F.col("c2").isNull(), "spans_exon_boundary"))
    fits = F.col("reason").isNull()
    up = Window.partitionBy("gid", "hap", fits).orderBy("lo", "hi", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("_clash", F.coalesce(F.col("lo") <= F.max("hi").over(up), F.lit(False))).withColumn("_any", F.max("_clash").over(Window.partitionBy("gid", "hap", fits)))
    both = both.withColumn("reason", F.when(fits & F.col("_any"), "in_cis_overlap").otherwise(F.col("reason")))
    cds = spliced(segs, contigs).select("gid", "cds")
    turn = lambda c: F.upper(F.when(F.col("strand") == "-", reverse_complement(F.col(c))).otherwise(F.col(c)))
    seen = F.substring("cds", F.col("lo").cast("int") + 1, (F.col("hi") - F.col("lo") + 1).cast("int"))
    judged = both.join(cds, "gid", "left").withColumn("reason", F.coalesce("reason", F.when(F.coalesce(F.upper(seen) != turn("ref"), F.lit(True)), "ref_mismatch"), F.lit("applied")))
    judged = judged.select("gid", "hap", "event_id", "lo", "hi", turn("alt").alias("alt"), "reason")
    edits = judged.where("reason = 'applied'").groupBy("gid", "hap").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "alt"))).alias("e"))
    haps = cds.select("gid", "cds", F.explode(F.array(F.lit("hap0"), F.lit("hap1"))).alias("hap")).join(edits, ["gid", "hap"], "left")
    behind = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("e", i - 1)["hi"] + 1)
    part = lambda a, b: F.substring("cds", a.cast("int") + 1, (b - a).cast("int"))
    whole = F.concat(F.array_join(F.transform("e", lambda x, i: F.concat(part(behind(i), x["lo"]), x["alt"])), ""), part(F.element_at("e", -1)["hi"] + 1, F.length("cds").cast("long")))
    return haps.select("gid", "hap", F.when(F.col("e").isNull(), F.col("cds")).otherwise(whole).alias("cds")), judged


@query("C08_personalize_cds", "fx_cds fx_ctg fx_vcf")
def c08(segs, contigs, variants):
    plain = _plain_variants(variants).join(variants.select(F.col("event_id").alias("line"), "gt"), "line").where("gt RLIKE '^[01][|][01]$'")
    allele = lambda k: F.when(F.substring("gt", k, 1) == "1", F.col("alt")).otherwise(F.col("ref"))
    _, judged = personal_sequences(segs, contigs, plain.select(F.col("line").alias("event_id"), "chrom", "pos", "ref", allele(1).alias("hap0"), allele(3).alias("hap1")))
    return judged.groupBy("hap", "reason").agg(F.count("*").alias("n"), F.count_distinct("gid").alias("transcripts"))
