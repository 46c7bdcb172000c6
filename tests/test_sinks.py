import glob

import pytest
from pyspark.sql import functions as F

from annotspark.plans import formats, paths
from annotspark.sources.sinks import HEADERS, write_lines


@pytest.mark.parametrize("files", ["one", "ranges"])
def test_features_come_back_as_they_were_written(spark, tmp_path, files):
    rows = [(g, c, "gene", s, s + 9, "+", None, f"{g}{c}{s}", None, None if s % 3 else "t") for g in ("g1", "g 2") for c in ("c2", "c10") for s in range(90, 1, -7)]
    feats = spark.createDataFrame(rows, "genome_id string, seqid string, type string, f_start long, f_end long, strand string, phase int, id string, parent string, locus_tag string")
    lines = formats.to_gff3(feats, ["genome_id", "f_start", "seqid"])
    write_lines(lines, str(tmp_path / "out"), [F.col("seqid"), F.col("f_start")], HEADERS["gff3"], files)
    own = {g: sorted(f for f in glob.glob(f"{tmp_path}/out/genome_id={g}/part-*")) for g in ("g1", "g 2")}
    for names in own.values():
        assert names and (len(names) == 1 or files == "ranges")
        said = "".join(open(n).read() for n in names).splitlines()
        assert said[0] == "##gff-version 3" and sum(x.startswith("##") for x in said) == 1
        places = [(x.split("\t")[0], int(x.split("\t")[3])) for x in said[1:]]
        assert places == sorted(places) and len(places) == 26
    back = paths.READERS["gff3"](spark, str(tmp_path / "out"))
    got = {(r["genome_id"], r["seqid"], r["start"], r["end"], r["attrs"]["ID"], r["attrs"].get("locus_tag")) for r in back.collect()}
    assert got == {(r[0], r[1], r[3], r[4], r[7], r[9]) for r in rows}
    with pytest.raises(Exception, match="(?i)already exists"):
        write_lines(lines, str(tmp_path / "out"), [F.col("seqid")])


def test_variants_come_back_as_they_were_written(spark, tmp_path):
    rows = [(g, "c", k, k, "A", "C", "PASS", "0|1") for g in ("a", "b") for k in range(30, 0, -1)]
    variants = spark.createDataFrame(rows, "genome_id string, chrom string, pos long, event_id long, ref string, alt string, filter_tag string, gt string")
    lines = formats.vcf_lines(variants, ["genome_id", "pos"])
    write_lines(lines, str(tmp_path / "out"), [F.col("pos")], HEADERS["vcf"], compression="gzip")
    back = paths.READERS["vcf"](spark, str(tmp_path / "out"))
    assert sorted((r["genome_id"], r["chrom"], r["pos"], r["ref"], r["alt"], r["gt"]) for r in back.collect()) == sorted((r[0], r[1], r[2], r[4], r[5], r[7]) for r in rows)
