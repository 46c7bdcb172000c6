"""Every registered query against its DuckDB oracle, on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from annotspark import registry

SF = "/root/testdata/sf0.001"
registry.load()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.sql(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{SF}/{f}'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, (int, float, Decimal)):
        return f"{float(v):.9g}"
    return str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in found)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry_point_without_the_corpus_package(monkeypatch):
    import builtins

    import __spark_entry__

    real = builtins.__import__

    def missing(name, globals=None, locals=None, fromlist=(), level=0):
        if name.startswith("annotspark.llm") or (name == "annotspark.llm"):
            raise ModuleNotFoundError(name, name="annotspark.llm")
        return real(name, globals, locals, fromlist, level)

    monkeypatch.setattr(builtins, "__import__", missing)
    assert not any(q.startswith("op") for q in __spark_entry__.queries())
