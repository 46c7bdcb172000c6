"""Views that are built on Spark hold what their templates say, in tasks of a bounded size."""

import pytest

from annotspark import fixtures, tables

SF = "/root/testdata/sf0.001"


def template(spark, name):
    if name in fixtures.TABLES:
        return fixtures.table(spark, SF, name)
    sql = fixtures.VIEWS[name]
    return fixtures._spark_sql(sql, **{n: template(spark, n) for n in fixtures._needs(sql)})


@pytest.mark.parametrize("name", ["fx_cds", "fx_feature", "fx_ctg"])
def test_built_views_equal_their_templates(spark, name):
    built, want = fixtures.table(spark, SF, name), template(spark, name)
    assert built.dtypes == want.dtypes
    assert built.exceptAll(want).isEmpty() and want.exceptAll(built).isEmpty()


def test_tasks_hold_no_more_as_tables_grow(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(tables, "ROWS", 500)
    monkeypatch.setattr(fixtures, "CONTIGS", 10)
    for name, most in (("fx_cds", 700), ("fx_ctg", 25)):
        sizes = [r["count"] for r in fixtures.table(spark, SF, name).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 8 and max(sizes) <= most


def test_features_gather_orders_once_and_keep_repeated_ones(spark, tmp_path):
    """One join for genes and segments together; orders of one key, lines without a quantity and null keys as the template has them."""
    orders = [(1, 7, "F"), (1, 7, "F"), (1, 7, "O"), (1, 7, "P"), (1, 8, None), (2, None, "O"), (None, 3, "F"), (39, 5, "O"), (33, 5, "F"), (50, 1, "O")]
    lines = [(1, 1, 10, 5.0), (1, 1, 9, None), (1, 7, 60, 3.0), (2, None, 4, 1.0), (2, 2, 4, None), (None, 1, 1, 1.0), (39, 2, None, 9.0), (39, 3, 51, 2.0), (33, 1, 8, 8.0), (60, 1, 1, 1.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    built = fixtures.table(spark, str(tmp_path), "fx_feature")
    made = {n: fixtures.table(spark, str(tmp_path), n) for n in ("orders", "lineitem")}
    made["fx_cds"] = fixtures._spark_sql(fixtures.VIEWS["fx_cds"], **made)
    made["fx_gene"] = fixtures._spark_sql(fixtures.VIEWS["fx_gene"], fx_cds=made["fx_cds"])
    want = fixtures._spark_sql(fixtures.VIEWS["fx_feature"], fx_gene=made["fx_gene"], fx_cds=made["fx_cds"])
    assert want.count() > 20 and built.exceptAll(want).isEmpty() and want.exceptAll(built).isEmpty()
    assert built._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1
