"""Every registered query that has SQL gives DuckDB's rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from lakeloom.plans import facts, marts
from lakeloom.plans.oracle import SQL
from lakeloom.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(table):
    columns = sorted(table.column_names)
    return columns, sorted((tuple(r[c] for c in columns) for r in table.to_pylist()), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf, duck, name):
    assert rows(QUERIES[name](spark, sf).toArrow()) == rows(duck.sql(SQL[name]).to_arrow_table())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_incremental_ingest(spark, sf):
    got = {r.batch_id: r for r in QUERIES["incremental_ingest"](spark, sf).collect()}
    assert sum(r.rows for r in got.values()) == sum(r.events for r in got.values()) == spark.read.parquet(f"{sf}/events.parquet").count()


def test_snapshot_diff_where_new_keys_meet_old_ones(spark, sf, duck, tmp_path):
    """More than a million parts: keys that the later snapshot adds are taken already, by parts of other brands."""
    part = "SELECT * FROM part UNION ALL SELECT * REPLACE (p_partkey + 1000000 AS p_partkey, p_brand || '!' AS p_brand, p_retailprice + p_partkey % 200 // 100 AS p_retailprice) FROM part"
    duck.sql(f"COPY ({part}) TO '{tmp_path}/part.parquet' (FORMAT parquet)")
    c = duckdb.connect()
    c.sql(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    got = rows(QUERIES["snapshot_diff"](spark, str(tmp_path)).toArrow())
    assert got == rows(c.sql(SQL["snapshot_diff"]).to_arrow_table())


def test_product_performance_deals_by_rows(spark, sf, duck, monkeypatch):
    """Joins and groups of the mart lie in as many partitions as there are rows for, whatever the session's number."""
    monkeypatch.setattr(marts, "FACT_ROWS_A_TASK", 500)
    monkeypatch.setattr(facts, "FACT_ROWS_A_TASK", 500)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    df = QUERIES["agg_product"](spark, sf)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 4 and plan.count(f", {-(-lines // 500)}") >= 4
    assert rows(df.toArrow()) == rows(duck.sql(SQL["agg_product"]).to_arrow_table())
