"""Readers over paths, with two genomes whose contigs and ids have the same names."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from annotspark.operators import consensus
from annotspark.operators import intervals as iv
from annotspark.plans import hierarchy, paths, repair
from annotspark.sources.fasta import fasta_tiles

T = "\t".join
#: By format: the lines of a file, and rows that are read from it.
FILES = {
    "gff3": (["##gff-version 3", T(["c", "s", "gene", "5", "9", ".", "+", ".", "ID=a;N=1;N=2;flag"]), T(["c", "s", "gene", "9", "5", ".", "+", ".", "ID=b"])], 1),
    "fasta": ([">s1 one", "acgt", "AC", ">s2", "tt"], 2), "fastq": (["@r1 x", "ACGT", "+", "IIII"], 1), "qual": ([">s1 x", "1 2 300", "4", ">s2", "5"], 2),
    "vcf": (["#CHROM", T(["c", "7", "v", "A", "C,G", "9.5", "PASS", "DP=3;DB;DP=4", "GT", "0|1"]), "short"], 1), "phased_vcf": ([T(["c", "7", "v", "A", "C", ".", ".", ".", "GT", "0|1"])], 1),
    "paf": ([T(["q", "9", "0", "9", "+", "t", "20", "1", "10", "8", "9", "60"]), "q\tx"], 1), "repeatmasker": (["h", "h", "", " 1 2 3 4 c 10 20 (0) C x y"], 1),
    "gtf": ([T(["c", "s", "CDS", "1", "9", ".", "+", "0", 'gene_id "g"; transcript_id "t";']), T(["c", "s", "CDS", "20", "29", ".", "+", "0", 'gene_id "g"; transcript_id "t";'])], 1),
    "snap": ([T(["c", "SNAP", "Exon", "1", "9", ".", "+", ".", "g1"]), T(["c", "SNAP", "Exon", "20", "29", ".", "+", ".", "g1"]), T(["c", "SNAP", "Exon", "50", "59", ".", "+", ".", "g2"])], 2),
    "glimmer": ([T(["c", "G", "mRNA", "1", "29", ".", "+", ".", "x"]), T(["c", "G", "CDS", "1", "9", ".", "+", "0", "x"]), T(["c", "G", "CDS", "20", "29", ".", "+", "0", "x"])], 1),
    "blast6": (["# c", T(["q", "t", "90.5", "oops", "50"])], 1), "domains": (["# c", " ".join(["d", "-", "90", "q", *["-"] * 8, "1e-5", *["0"] * 4, "3", "60", *["0"] * 4])], 1),
    "emapper": (["#q", T(["q", "s", "1", "2", "og", "x", "S", "d", "n", "GO:1,GO:2", "-", "-", "ko1"]), T(["q", "s", "1", "2", "og2", "x", "S", "d", "n", "-", "-", "-", "-"])], 1),
    "interproscan": ([T(["q", "m", "9", "Pfam", "PF1", "d", "1", "5", "1e-9", "T", "date", "IPR1", "d", "GO:0000001|GO:0000002"]), T(["q", "m", "9", "Pfam", "PF2", "d", "1", "5", "1e-9", "FALSE", "date"])], 1),
    "dbcan": (["Gene ID\tHMMER\tHotpep\tDIAMOND", T(["q", "GH1(1-9)+CBM1", "-", "AA9", "2"])], 3), "trnascan": (["Sequence", "c 1 100 20 Leu CAA 0 0 61.5"], 1),
    "bgc_regions": ([T(["c", "a", "region", "1", "9", ".", "+", ".", "rules=NRPS"]), T(["c", "a", "gene", "1", "9", ".", "+", ".", "ID=x"])], 1), "busco": (["# h", T(["b1", "Complete", "c", "90", "10", "-"])], 1),
    "quant_sf": ([T(["Name", "Length", "EffectiveLength", "TPM", "NumReads"]), T(["t1", "9", "8", "1.5", "3"])], 1), "abundance": ([T(["tpm", "target_id", "est_counts"]), T(["1.5", "t1", "3"])], 1),
    "orthogroups": ([T(["Orthogroup", "A", "B"]), T(["OG1", "a1, a2", "b1"]), T(["OG2", "", "b2"])], 4), "sample_sheet": ([T(["sample_id", "fastq_r1", "group"]), T(["s1", "x.fq", "one"]), T(["s1", "y.fq", "two"])], 2),
    "run_report": ([T(["R1", "u1;u2", "m1;m2"])], 2), "topology": (["q 2 Y o"], 1), "sam": (["@HD", T(["r", "0", "c", "5", "60", "3M2I5N4M", "*", "0", "0", "A", "I"])], 1), "names": (["# n", "a\tb", "a\tb"], 1),
    "metrics": (['{"genome": "g", "tool": "t", "scores": {"f1": 0.5}}'], 1), "format": (["##gff-version 3"], 1),
}


@pytest.mark.parametrize("name", sorted(paths.READERS))
def test_two_genomes_give_the_union_of_their_rows(spark, tmp_path, name):
    text, rows = "\n".join(FILES[name][0]) + "\n", FILES[name][1]
    for g in ("g1", "g2"):
        (tmp_path / f"genome_id={g}").mkdir()
        (tmp_path / f"genome_id={g}" / "x.tsv").write_text(text)
    read = paths.READERS[name]
    both, alone = read(spark, str(tmp_path)), read(spark, str(tmp_path / "genome_id=g1" / "x.tsv"))
    assert both.columns[0] == "genome_id" and both.columns == alone.columns
    plain = lambda df: sorted(str({k: v for k, v in r.asDict().items() if k not in ("genome_id", "file", "sample")}) for r in df.collect())
    want = plain(alone)
    assert len(want) == rows
    for g in ("g1", "g2"):
        assert plain(both.where(F.col("genome_id") == g)) == want


def test_a_genome_is_named_by_its_file_and_prunes_folders(spark, tmp_path):
    for g in ("a", "b"):
        (tmp_path / "t" / f"genome_id={g}").mkdir(parents=True)
        (tmp_path / "t" / f"genome_id={g}" / "x.gff3").write_text(FILES["gff3"][0][1] + "\n")
        with gzip.open(tmp_path / f"{g}.v2.gff3.gz", "wt") as f:
            f.write(FILES["gff3"][0][1] + "\n")
    assert {r["genome_id"] for r in paths.READERS["gff3"](spark, str(tmp_path / "*.gz")).collect()} == {"a", "b"}
    one = paths.READERS["gff3"](spark, str(tmp_path / "t")).where("genome_id = 'a'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1 and "PartitionFilters: [isnotnull(genome_id" in plan


def test_attributes_and_flags(spark, tmp_path):
    for name in ("gff3", "vcf"):
        (tmp_path / f"g.{name}").write_text("\n".join(FILES[name][0]))
    assert paths.READERS["gff3"](spark, str(tmp_path / "g.gff3")).first()["attrs"] == {"ID": "a", "N": "2"}
    assert paths.READERS["vcf"](spark, str(tmp_path / "g.vcf")).first()["info"] == {"DP": "4", "DB": None}


def plain_fasta(path):
    with gzip.open(path, "rt", newline="") if str(path).endswith(".gz") else open(path, newline="") as f:
        out = []
        for line in f.read().split("\n"):
            if line.startswith(">"):
                out.append([(line[1:].split() or [""])[0], ""])
            elif out:
                out[-1][1] += "".join(line.split()).upper()
    return [tuple(x) for x in out if x[1]]


def test_fasta_tiles_equal_plain_reading(spark, tmp_path):
    rng = random.Random(1)
    for n in range(4):
        with gzip.open(tmp_path / "g3.fa.gz", "wt") if n == 3 else open(tmp_path / f"g{n}.fa", "w", newline="") as f:
            if n % 2:
                f.write("junk before\nacgt\n")
            for _ in range(6):
                f.write(f">s{rng.randint(0, 3)} some {'x' * rng.choice([0, 3, 400])}\n")
                s = "".join(rng.choice("acgtN") for _ in range(rng.choice([0, 1, 50, 777, 2000])))
                w, end = rng.choice([10, 60, 5000]), rng.choice(["\n", "\r\n"])
                f.write("".join(s[k : k + w] + end for k in range(0, len(s), w)))
    for split, last in ((300, False), (1 << 20, True)):
        found = {}
        for r in sorted(fasta_tiles(spark, str(tmp_path), last_wins=last, split=split, tile=64).collect(), key=lambda r: (r["file"], r["record"], r["tile"])):
            found.setdefault((r["file"].rsplit("/", 1)[1], r["record"], r["seqid"]), []).append(r["part"])
        for name in ("g0.fa", "g1.fa", "g2.fa", "g3.fa.gz"):
            want = plain_fasta(tmp_path / name)
            got = [(i, "".join(parts)) for (f, _, i), parts in found.items() if f == name]
            assert sorted(got) == sorted(dict(want).items() if last else want)
        assert all(len(p) == 64 for parts in found.values() for p in parts[:-1])


def test_a_long_record_is_read_by_several_tasks(spark, tmp_path):
    seq = "".join(random.Random(2).choice("acgt") for _ in range(3_000_000))
    (tmp_path / "long.fa").write_text(">chr1\n" + "\n".join(seq[k : k + 70] for k in range(0, len(seq), 70)) + "\n>chr2\nacgt\n")
    tiles = fasta_tiles(spark, str(tmp_path / "long.fa"), split=1 << 18)
    rows = tiles.withColumn("task", F.spark_partition_id()).collect()
    assert len({r["task"] for r in rows}) > 4
    assert "".join(r["part"] for r in sorted(rows, key=lambda r: (r["record"], r["tile"]))) == seq.upper() + "ACGT"


def test_operators_hold_genomes_apart(spark):
    rng = random.Random(9)
    genes, segs, rows = [], [], []
    for g in ("g1", "g2"):
        for k in range(40):
            s, strand = rng.randint(1, 3000), rng.choice("+-")
            parts = [(s + 200 * j, s + 200 * j + rng.randint(30, 150)) for j in range(rng.randint(1, 3))]
            segs += [(g, k, "c", strand, a, b) for a, b in parts]
            genes.append((g, k, "c", strand, rng.choice(["snap", "protein"]), rng.choice([3.0, 20.0]), parts[0][0], parts[-1][1], len(parts), sum(b - a + 1 for a, b in parts)))
            rows.append((g, "gene", 1, s, s + 9, f"i{k}", None, f"t{k}" if k % 3 else None, "c"))
            rows.append((g, "CDS", 3, s, s + 9, f"c{k}", f"i{rng.randint(0, 60)}", None, "c"))
    genes = spark.createDataFrame(genes, "genome_id string, gid long, seqid string, strand string, source string, weight double, g_start long, g_end long, n_seg int, cds_len long")
    segs = spark.createDataFrame(segs, "genome_id string, gid long, seqid string, strand string, seg_start long, seg_end long")
    feats = spark.createDataFrame(rows, "genome_id string, type string, lvl int, f_start long, f_end long, id string, parent string, locus_tag string, seqid string")
    cases = {
        "consensus": (lambda a, b: consensus.winners(consensus.scored(a, b)).select("gid", "locus", F.round("score", 6).alias("score")), (genes, ("gid", "seqid")), (segs, ("gid", "seqid")), ("gid",)),
        "merge": (lambda a: iv.merge(a, ["seqid"], "seg_start", "seg_end"), (segs, ("gid", "seqid")), None, ("seqid",)),
        "jaccard": (lambda a: iv.jaccard(a, "gid", ["seqid", "strand"], "seg_start", "seg_end"), (segs, ("gid", "seqid")), None, ("a", "b")),
        "ancestors": (hierarchy.j03, (feats, ("id", "parent", "seqid")), None, ("id",)),
        "issues": (lambda a: repair.structure_issues(a, ["genome_id"]).groupBy("genome_id", "kind").count(), (feats, ()), None, ()),
    }
    plain = lambda df: sorted(str(r.asDict()) for r in df.collect())
    for f, one, two, ids in cases.values():
        tables = [t for t in (one, two) if t]
        if ids:
            both = paths.unscoped(f(*[paths.scoped(t, *own) for t, own in tables]), *ids)
            want = [plain(f(*[t.where(F.col("genome_id") == g).drop("genome_id") for t, _ in tables])) for g in ("g1", "g2")]
            got = [plain(both.where(F.col("genome_id") == g).drop("genome_id")) for g in ("g1", "g2")]
        else:
            got = [plain(f(one[0]).where(F.col("genome_id") == g)) for g in ("g1", "g2")]
            want = [plain(f(one[0].where(F.col("genome_id") == g))) for g in ("g1", "g2")]
        assert got == want and all(want)
