"""Table store, sources, streaming and the stages end to end on small landed files."""

import json
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import config as C
from lakeloom.plans import audit, runner, session_views
from lakeloom.sources import files, rest, session
from lakeloom.sources.tablestore import CommitConflict, Table


def test_table_versions(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), ["id"])
    assert not t.exists() and t.version() == -1
    a = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    t.overwrite(a)
    assert t.merge(spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")) == {"inserted": 1, "updated": 1, "ignored": 0}
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, t.read(0).collect())) == [(1, "a"), (2, "b")]
    assert sorted((r.id, r._change_type) for r in t.changes(0).collect()) == [(2, "update"), (3, "insert")]
    t.append(spark.createDataFrame([(4, "d", 1)], "id int, v string, extra int"))
    assert t.read().count() == 4 and "extra" in t.read().columns
    t.optimize(1)
    with pytest.raises(ValueError):
        t.vacuum(1)
    gone = t.vacuum(0, now=time.time() + 10, force=True)
    assert gone and t.read().count() == 4 and len(t.history()) == 1
    with pytest.raises(ValueError):
        t.merge(a.unionAll(a))


def test_source_dir():
    assert files.source_dir("erp/orders/dt=*/*.parquet") == "erp/orders"
    assert files.source_dir("stores/*.csv") == "stores"
    assert files.source_dir("a/b.csv") == "a"


def test_drift():
    old = T.StructType.fromDDL("a int, b string")
    assert files.check_drift(old, T.StructType.fromDDL("b string, a int, c date")).names == ["a", "b", "c"]
    with pytest.raises(files.SchemaDriftError):
        files.check_drift(old, T.StructType.fromDDL("a int"))
    with pytest.raises(files.SchemaDriftError):
        files.check_drift(old, T.StructType.fromDDL("a string, b string"))
    assert files.hinted(old, "a long, z int").simpleString() == "struct<a:bigint,b:string,z:int>"


def test_rest_pages():
    calls = []

    def get(url, token):
        calls.append(url)
        return (500, b"") if len(calls) < 3 else (200, b'{"total": 1, "items": []}')

    assert rest.fetch("u", "t", wait=0, get=get)["total"] == 1 and len(calls) == 3
    assert rest.page_url("http://x", 2, 500, "2024-01-01") == "http://x?page=2&page_size=500&updated_since=2024-01-01"
    with pytest.raises(ValueError):
        rest.page_url("http://x", 1, 501, None)
    with pytest.raises(RuntimeError):
        rest.fetch("u", "t", get=lambda u, t: (401, b""))


def envelope_rows(table, key, rows):
    return [{"op": op, "ts_ms": 1, "before": b, "after": a, "source": {"db": "erp", "table": table, "lsn": lsn, "snapshot": "false"}} for op, b, a, lsn in rows]


@pytest.fixture
def lake(tmp_path, monkeypatch, spark):
    monkeypatch.setenv("LAKE_ROOT", str(tmp_path))
    env = C.load_environment("local").model_copy(update={"fail_threshold": 0.5})
    land = tmp_path / "landing"

    def put(path, text):
        p = land / path
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)

    put("categories/dt=2024-01-01/a.csv", "category_id,category_name,parent_category_id,department,updated_at\nc1,Shoes,,D,2024-01-01T00:00:00Z\n")
    put("products/dt=2024-01-01/a.csv", "product_id,product_name,category_id,brand,price,cost,supplier,status,updated_at\np1,Boot,c1,B,10.00,4.00,S,active,2024-01-01T00:00:00Z\np1,Boot,c1,B,12.00,4.00,S,active,2024-02-01T00:00:00Z\n")
    customer = {"customer_id": "u1", "first_name": "A", "last_name": "L", "email": "a@b.c", "phone": "1", "address_line1": "x", "city": "Y", "state": "ny", "country": "us", "postal_code": "12345", "signup_date": "2024-01-01", "customer_segment": "retail", "updated_at": "2024-01-01T00:00:00Z"}
    put("customers/dt=2024-01-01/a.json", json.dumps(customer) + "\n" + json.dumps(customer | {"customer_id": "u2", "email": None}) + "\nnot json\n")
    order = {"order_id": "o1", "customer_id": "u1", "order_date": "2024-01-15T00:00:00", "order_status": "PLACED", "payment_status": "CAPTURED", "region": "NORTHEAST", "currency": "USD", "updated_at": "2024-01-15T00:00:00"}
    events = envelope_rows("orders", "order_id", [("c", None, order, 10), ("u", order, order | {"order_status": "SHIPPED"}, 20), ("u", order, order | {"order_status": "STALE"}, 15), ("c", None, order | {"order_id": "o2", "order_status": "CANCELLED"}, 30)])
    item = {"order_id": "o1", "order_line_number": 1, "product_id": "p1", "quantity": 2, "unit_price": "10.00", "discount_amount": "1.00", "tax_amount": "0.50", "updated_at": "2024-01-15T00:00:00"}
    items = envelope_rows("order_items", "order_id", [("c", None, item, 11), ("c", None, item | {"order_id": "o2"}, 31), ("c", None, item | {"order_line_number": 2, "quantity": -1}, 12)])
    for name, body, schema in (("orders", events, order), ("order_items", items, item)):
        image = "struct<" + ",".join(f"{k}:{'int' if isinstance(v, int) else 'string'}" for k, v in schema.items()) + ">"
        df = spark.createDataFrame([json.dumps(e) for e in body], "string").select(F.from_json("value", f"op string, ts_ms long, before {image}, after {image}, source struct<db:string,table:string,lsn:long,snapshot:string>").alias("e")).select("e.*")
        df.coalesce(1).write.parquet(str(land / f"erp/{name}/dt=2024-01-15"))
    return env, put, customer


def test_stages(spark, lake):
    env, put, customer = lake
    names = ("categories", "products", "customers", "orders", "order_items")
    entities = {n: e for n, e in C.load_entities().items() if n in names}
    env = env.model_copy(update={"max_parallel": 1})
    bronze = runner.run_bronze(spark, env, entities, "b1")
    assert {n: r["status"] for n, r in bronze.items()} == dict.fromkeys(names, "SUCCESS"), bronze
    assert bronze["customers"]["rows"] == 3 and bronze["customers"]["rescued"] == 1
    again = runner.run_bronze(spark, env, entities, "b2")
    assert all(r["rows"] == 0 for r in again.values())
    silver = runner.run_silver(spark, env, entities, "b1")
    assert silver["orders"]["status"] == "SUCCESS", silver
    assert silver["order_items"] == {"status": "SUCCESS", "rows": 2, "quarantined": 1}
    # the broken line has no key, which is fatal for its entity alone
    assert silver["customers"]["status"] == "FATAL_DQ"
    orders = Table(spark, env.table_path("silver", "orders")).read()
    assert {(r.order_id, r.order_status) for r in orders.collect()} == {("o1", "SHIPPED"), ("o2", "CANCELLED")}
    versions = Table(spark, env.table_path("gold", "dim_products")).read()
    assert versions.count() == 2 and versions.where("is_current").first().price == 12.0
    counts = runner.run_gold(spark, env, "b1")
    assert counts["fact_sales"] == 2 and counts["agg_daily_sales"] == 1
    sale = Table(spark, env.table_path("gold", "fact_sales")).read().where("order_id = 'o1'").first()
    assert str(sale.net_amount) == "19.00" and sale.product_sk == versions.where("not is_current").first().products_sk
    checks = runner.run_reconcile(spark, env)
    assert {r["status"] for r in checks} == {"PASSED"} and {r["check_name"] for r in checks} == {"row_flow", "soft_delete_rate", "grain", "net_revenue"}
    lake = runner.Lake(spark, env)
    made = session_views.register(lake)
    assert {"v_q01_revenue_by_period", "v_q13_latest_vs_trend", "v_executive_kpis", "v_sales_summary", "v_run_status", "v_pii_inventory"} - set(made) == {"v_executive_kpis"}
    assert spark.sql("SELECT sum(orders) FROM v_q01_revenue_by_period").first()[0] == 1
    for name in made:
        spark.table(name).collect()
    assert set(runner.run_gold(spark, env, "b1", ["agg_daily_sales"])) == {"agg_daily_sales"}
    with pytest.raises(ValueError):
        runner.run_gold(spark, env, "b1", ["nothing"])
    runs = audit.Audit(spark, env).tables["runs"].read()
    assert runs.where("status = 'FATAL_DQ' and entity = 'customers'").count() == 1


PRODUCT = "product_id,product_name,category_id,brand,price,cost,supplier,status,updated_at\n"


def test_second_delivery(spark, lake):
    """A full load deletes what it lacks; a bad row makes no version; deletions reach the dimension; four threads."""
    env, put, _ = lake
    entities = {n: e for n, e in C.load_entities().items() if n in ("categories", "products", "orders", "order_items")}
    env = env.model_copy(update={"max_parallel": 4})
    put("products/dt=2024-01-02/b.csv", PRODUCT + "p2,Hat,c1,B,5.00,1.00,S,active,2024-01-02T00:00:00Z\np3,Cap,c1,B,6.00,1.00,S,active,2024-01-02T00:00:00Z\n")
    runner.run_bronze(spark, env, entities, "b1")
    assert {r["status"] for r in runner.run_silver(spark, env, entities, "b1").values()} == {"SUCCESS"}
    put("products/dt=2024-03-01/c.csv", PRODUCT + "p1,Boot,c1,B,12.00,4.00,S,active,2024-03-01T00:00:00Z\np3,Cap,c1,B,-6.00,1.00,S,active,2024-03-01T00:00:00Z\np4,Tie,c1,B,7.00,1.00,S,active,2024-03-01T00:00:00Z\n")
    runner.run_bronze(spark, env, entities, "b2")
    silver = runner.run_silver(spark, env, entities, "b2")
    assert silver["products"] == {"status": "SUCCESS", "rows": 2, "quarantined": 1} and silver["orders"]["rows"] == 0
    products = {r.product_id: r for r in Table(spark, env.table_path("silver", "products")).read().collect()}
    assert {k: r.is_deleted for k, r in products.items()} == {"p1": False, "p2": True, "p3": False, "p4": False}
    assert float(products["p3"].price) == 6.0
    dim = Table(spark, env.table_path("gold", "dim_products")).read()
    assert not dim.where("cast(price as double) < 0").count()
    assert {(r.product_id, r.is_deleted) for r in dim.where("is_current").collect()} == {("p1", False), ("p2", True), ("p3", False), ("p4", False)}
    runs = audit.Audit(spark, env).tables["runs"].read()
    assert runs.where("stage = 'bronze'").count() == 8 and runs.where("status <> 'SUCCESS'").count() == 0
    again = runner.run_silver(spark, env, entities, "b2")
    assert {r["rows"] for r in again.values()} == {0}


def test_concurrent_commits(spark, tmp_path):
    path = str(tmp_path / "t")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: Table(spark, path).append(spark.createDataFrame([(k,)], "id int")), range(12)))
    t = Table(spark, path)
    assert sorted(r.id for r in t.read().collect()) == list(range(12)) and t.version() == 11
    with pytest.raises(CommitConflict):
        t._commit("overwrite", ["x"], {}, based_on=3)


def test_inferred_members(spark, lake):
    env, _, _ = lake
    entities = {n: e for n, e in C.load_entities().items() if n in ("products", "orders", "order_items")}
    runner.run_bronze(spark, env, entities, "b1")
    runner.run_silver(spark, env, entities, "b1")
    at = runner.Lake(spark, env)
    at.table("silver", "order_items").append(at.silver("order_items").limit(1).withColumn("product_id", F.lit("p9")).withColumn("order_line_number", F.lit(9)))
    runner.run_gold(spark, env, "b1")
    assert at.gold("dim_products").where("is_inferred").select("product_id").collect()[0][0] == "p9"
    assert at.gold("fact_sales").where("product_id = 'p9' and product_sk <> -1").count() == 1


def test_rows_to_frame(spark):
    assert session.rows_to_frame(spark, [{"a": 1}], "a int, b string").first().b is None
