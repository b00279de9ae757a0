"""Catalog views: they outlast a session, follow commits, and show each reader what their roles allow."""

import pytest
from pyspark.sql import functions as F

from lakeloom.config import Environment
from lakeloom.functions import masks
from lakeloom.plans import catalog, runner
from lakeloom.sources.tablestore import Table


@pytest.fixture
def lake(spark, tmp_path):
    env = Environment(name="demo", warehouse=str(tmp_path / "w"), landing_root=str(tmp_path / "l"), checkpoint_root=str(tmp_path / "c"), schema_root=str(tmp_path / "s"))
    rows = [("u1", "a@b.c", "12345", False), ("u2", "none", "9", False), ("u3", None, None, True), ("u4", "d@e.f", "55555", None)]
    Table(spark, env.table_path("gold", "dim_customers"), ["customer_id"], buckets=4).overwrite(spark.createDataFrame(rows, "customer_id string, email string, postal_code string, is_deleted boolean"))
    Table(spark, env.table_path("gold", "dim_products"), ["product_id"]).overwrite(spark.createDataFrame([("p1", 2.5)], "product_id string, cost double"))
    Table(spark, env.table_path("audit", "runs")).overwrite(spark.createDataFrame([], "run_id string"))
    yield runner.Lake(spark, env)
    for db in ("secured", "governance", "gold", "audit", "silver", "bronze"):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")


def test_views_last_and_guard(spark, lake):
    me = spark.sql("SELECT current_user()").first()[0]
    assert set(catalog.publish(lake)) == {"gold.dim_customers", "gold.dim_products", "audit.runs"}
    catalog.set_roles(spark, {me: ["analyst"], "someone": ["pii_reader"]})
    assert set(catalog.secure(lake)) == {"secured.dim_customers", "secured.dim_products"}
    other = spark.newSession()
    see = lambda: {r.customer_id: (r.email, r.postal_code) for r in other.table("secured.dim_customers").collect()}
    masked = {r[0]: (r[1], r[2]) for r in lake.gold("dim_customers").select("customer_id", masks.mask_email(F.col("email")), masks.mask_postal(F.col("postal_code"))).collect() if r[0] != "u3"}
    assert see() == masked and masked["u1"][0] != "a@b.c"
    assert other.table("secured.dim_products").first().cost is None and other.table("audit.runs").count() == 0
    catalog.set_roles(spark, {me: ["pii_reader", "finance"]})
    for session in (other, spark.newSession()):
        session.catalog.refreshTable(catalog.ROLES)
    assert see() == {"u1": ("a@b.c", "12345"), "u2": ("none", "9"), "u3": (None, None), "u4": ("d@e.f", "55555")}
    assert other.table("secured.dim_products").first().cost == 2.5
    # a commit, with a column more, is seen after the table's view is renewed
    lake.table("gold", "dim_customers").merge(spark.createDataFrame([("u5", "x@y.z", "1", False, "gold")], "customer_id string, email string, postal_code string, is_deleted boolean, tier string"))
    catalog.publish(lake, ["gold.dim_customers"])
    assert see()["u5"] == ("x@y.z", "1") and other.table("gold.dim_customers").where("tier = 'gold'").count() == 1
    with pytest.raises(ValueError):
        catalog.set_roles(spark, {me: ["king"]})
