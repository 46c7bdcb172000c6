"""Digests of whole files that no task holds, against hashlib."""

import hashlib
import random

import pytest

from annotspark.plans import outputs
from annotspark.sources.digests import digests


def said(raw: bytes) -> tuple:
    return len(raw), hashlib.md5(raw).hexdigest(), hashlib.sha256(raw).hexdigest()


@pytest.fixture
def held(spark):
    """Settings for one test."""
    old = {}

    def set_to(key, value):
        old.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield set_to
    for k, v in old.items():
        spark.conf.set(k, v)


def test_no_file_is_held_in_a_cell(spark, held):
    """A file larger than a cell may be, read in ranges."""
    held("spark.sql.sources.binaryFile.maxLength", "1000")
    held("spark.sql.files.maxPartitionBytes", "700")
    path = "/root/testdata/sf0.001"
    rows = {r["file"]: r for r in outputs.file_manifest(spark, path, ["region", "nation", "supplier"]).collect()}
    for f, n in (("region", 5), ("nation", 25), ("supplier", 10)):
        r = rows[f"{f}.parquet"]
        assert (r["bytes"], r["md5"], r["sha256"]) == said(open(f"{path}/{f}.parquet", "rb").read()) and r["rows"] == n
    assert len(rows) == 3


@pytest.mark.parametrize("split", ["100", "4096", "100m"])
def test_digests_of_any_bytes(spark, held, tmp_path, split):
    """Breaks at the end, at the borders of ranges, one behind the other and none at all; batches of a few rows."""
    rng = random.Random(5)
    files = {
        "noise": rng.randbytes(20_000), "end": rng.randbytes(1000) + b"\n", "two": b"PAR1\n\n\r\n\r\n\n", "one": b"x", "break": b"\n", "none": b"\0" * 9000, "breaks": b"\n" * 5000,
        "borders": (b"a" * 99 + b"\n") * 30, "behind": b"\n" + (b"b" * 99 + b"\n") * 30, "a b%20c+é": b"\r\n" * 50 + b"\xff",
    }
    (tmp_path / "deep").mkdir()
    for k, v in files.items():
        (tmp_path / ("deep" if k == "end" else "") / f"{k}.parquet").write_bytes(v)
    (tmp_path / "other.txt").write_bytes(b"1")
    held("spark.sql.files.maxPartitionBytes", split)
    held("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = {r["name"]: (r["bytes"], r["md5"], r["sha256"]) for r in digests(spark, [str(tmp_path)], piece=64).collect()}
    assert got == {f"{k}.parquet": said(v) for k, v in files.items()}


def test_files_of_one_name_and_tables_without_rows(spark, tmp_path):
    made = {"a": 3, "b": 5, "c": 0}
    for t, n in made.items():
        (tmp_path / f"{t}.parquet").mkdir()
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / "made" / t))
        (raw,) = (tmp_path / "made" / t).glob("part-*")
        (tmp_path / f"{t}.parquet" / "data 0.parquet").write_bytes(raw.read_bytes())
    rows = outputs.file_manifest(spark, str(tmp_path), sorted(made)).collect()
    assert sorted((r["file"], r["rows"]) for r in rows) == [("data 0.parquet", 0), ("data 0.parquet", 3), ("data 0.parquet", 5)]
    assert {r["sha256"] for r in rows} == {said((tmp_path / f"{t}.parquet" / "data 0.parquet").read_bytes())[2] for t in made}
