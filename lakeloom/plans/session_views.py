"""The 23 business, operations and secured views, by name, for a session that asks in SQL.

Tables are versioned folders, so a view is bound to their versions when it is registered; register() again
after a commit. A view whose tables aren't there yet is left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.plans import governance, marts, views

BY_VERSION = {"customers": "customer_sk", "products": "product_sk", "stores": "store_sk", "promotions": "promotion_sk"}


def _dimension(lake, name: str, key: str, columns: list[str]) -> DataFrame:
    """A dimension under the facts' name of its key; columns and tables that are missing come as NULLs."""
    if not lake.there(name, "gold"):
        return lake.spark.createDataFrame([], ", ".join([f"{key} long", *(f"{c} string" for c in columns)]))
    df = lake.gold(name)
    sk = f"{name.removeprefix('dim_')}_sk"
    return df.select(F.col(sk).alias(key), *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def _products(lake) -> DataFrame:
    """Product versions with the name of their category."""
    p = _dimension(lake, "dim_products", "product_sk", ["product_name", "brand", "category_id"])
    c = lake.gold("dim_categories").select("category_id", "category_name") if lake.there("dim_categories", "gold") else lake.spark.createDataFrame([], "category_id string, category_name string")
    return p.join(c, "category_id", "left").drop("category_id")


def _with_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.withColumns({k: F.lit(-1).cast("long") for k in keys if k not in df.columns})


def sales_star(lake) -> DataFrame:
    """fact_sales with the attributes of the versions it names."""
    sales = _with_keys(lake.gold("fact_sales"), *BY_VERSION.values())
    customers = _dimension(lake, "dim_customers", "customer_sk", ["region", "customer_segment"])
    stores = _dimension(lake, "dim_stores", "store_sk", ["store_name", "region"])
    promotions = _dimension(lake, "dim_promotions", "promotion_sk", ["promotion_name", "promo_type", "discount_value"])
    return views.star(sales, lake.gold("dim_date"), customers, _products(lake), stores, promotions, BY_VERSION)


def _stock(lake) -> DataFrame:
    inventory = _with_keys(lake.gold("fact_inventory_snapshot"), "product_sk", "store_sk")
    return views.stocked(inventory, lake.gold("dim_date"), _products(lake), _dimension(lake, "dim_stores", "store_sk", ["store_name", "region"]), {"products": "product_sk", "stores": "store_sk"})


def _returns(lake) -> DataFrame:
    live = lake.gold("fact_sales").where(~F.col("is_cancelled")).select("order_id").distinct()
    return lake.gold("fact_returns").join(live, "order_id", "left_semi")


def _ago(hours: int):
    return F.current_timestamp() - F.expr(f"interval {hours} hours")


#: Tables that a view needs, and what it shows.
VIEWS: dict[str, tuple[list[str], Callable]] = {
    "v_q01_revenue_by_period": (["gold.fact_sales"], lambda k: views.revenue_by_period(sales_star(k))),
    "v_q02_revenue_by_region": (["gold.fact_sales"], lambda k: views.revenue_by_region(sales_star(k))),
    "v_q03_revenue_by_product": (["gold.fact_sales"], lambda k: views.revenue_by_product(sales_star(k))),
    "v_q04_average_order_value": (["gold.fact_sales"], lambda k: views.average_order_value(sales_star(k))),
    "v_q05_customer_lifetime_value": (["gold.agg_customer_lifetime"], lambda k: views.lifetime_deciles(k.gold("agg_customer_lifetime"))),
    "v_q06_return_rate": (["gold.fact_sales", "gold.fact_returns"], lambda k: views.return_rate(sales_star(k), _returns(k))),
    "v_q07_inventory_availability": (["gold.fact_inventory_snapshot"], lambda k: views.inventory_availability(_stock(k))),
    "v_q08_stockout_frequency": (["gold.fact_inventory_snapshot"], lambda k: views.stockout_frequency(_stock(k))),
    "v_q09_cohort_retention": (["gold.agg_customer_cohort"], lambda k: views.cohort_retention(k.gold("agg_customer_cohort"))),
    "v_q10_conversion_rate": (["gold.fact_customer_events"], lambda k: views.conversion(k.gold("fact_customer_events"), ("PRODUCT_VIEW", "CART_ADD", "ORDER_CREATED"))),
    "v_q11_fulfilment_time": (["gold.fact_order_fulfillment"], lambda k: views.fulfilment_time(_with_keys(k.gold("fact_order_fulfillment"), "store_sk"), _dimension(k, "dim_stores", "store_sk", ["store_name", "region"]), "store_sk")),
    "v_q12_promotion_impact": (["gold.fact_sales"], lambda k: views.promotion_impact(sales_star(k))),
    "v_q13_latest_vs_trend": (["gold.fact_sales"], lambda k: views.latest_vs_trend(marts.totals(sales_star(k), "full_date", "region"), "region", "full_date")),
    "v_executive_kpis": (["gold.fact_sales", "gold.agg_customer_lifetime", "gold.agg_product_performance"], lambda k: views.executive_kpis(k.gold("fact_sales"), k.gold("agg_customer_lifetime"), k.gold("agg_product_performance"))),
    "v_run_status": (["audit.runs"], lambda k: views.run_status(k.table("audit", "runs").read(), _ago(168))),
    "v_duration_trend": (["audit.runs"], lambda k: views.duration_trend(k.table("audit", "runs").read())),
    "v_dq_summary": (["audit.quality"], lambda k: views.dq_summary(k.table("audit", "quality").read(), _ago(720))),
    "v_reconciliation_status": (["audit.reconciliation"], lambda k: views.reconciliation_status(k.table("audit", "reconciliation").read(), _ago(168))),
    "v_freshness": (["audit.runs"], lambda k: views.freshness(k.table("audit", "runs").read(), F.current_timestamp())),
    "v_pipeline_health": (["audit.runs", "audit.quality", "audit.reconciliation"], lambda k: views.pipeline_health(*(k.table("audit", n).read() for n in ("runs", "quality", "reconciliation")), _ago(24), F.current_timestamp())),
    "v_sales_summary": (["gold.fact_sales"], lambda k: views.sales_summary(sales_star(k))),
    "v_inventory_health": (["gold.fact_inventory_snapshot"], lambda k: views.inventory_health(_stock(k))),
    "v_pii_inventory": ([], lambda k: views.pii_inventory(governance.tag_table(k.spark))),
}


def register(lake, only: list[str] | None = None) -> list[str]:
    """Creates the views in the session; the names of those whose tables are there."""
    made = []
    for name, (needs, build) in VIEWS.items():
        if (only is None or name in only) and all(lake.there(n.split(".")[1], n.split(".")[0]) for n in needs):
            build(lake).createOrReplaceTempView(name)
            made.append(name)
    return made
