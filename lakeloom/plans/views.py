"""Business questions and operational views over facts, marts and audit tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.ranking import tiles
from lakeloom.plans.marts import dated, ratio, sold, totals

D = "decimal(18,2)"
EXACT = 1_000_000  # accuracy at which percentile_approx is exact for groups up to this size


def _sum(name: str, out: str) -> Column:
    return F.sum(name).cast(D).alias(out)


def star(sales: DataFrame, dates: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, promotions: DataFrame | None = None, by: dict[str, str] | None = None) -> DataFrame:
    """Sales with the calendar and the attributes that views show, each dimension joined on its key.

    Keys are business keys, or what `by` names instead (a version's surrogate key). Unknown members are NULL.
    """
    by = {"customers": "customer_id", "products": "product_id", "stores": "store_id", "promotions": "promotion_id"} | (by or {})
    df = dated(sales.drop("region", "customer_segment", "category_id", "category_name"), dates)
    df = df.join(customers.select(by["customers"], "region", "customer_segment"), by["customers"], "left")
    df = df.join(products.select(by["products"], "product_name", "brand", "category_name"), by["products"], "left")
    df = df.join(stores.select(by["stores"], "store_name", F.col("region").alias("store_region")), by["stores"], "left")
    if promotions is not None:
        df = df.join(promotions.select(by["promotions"], "promotion_name", "promo_type", "discount_value"), by["promotions"], "left")
    return df


def revenue_by_period(star: DataFrame) -> DataFrame:
    """Q1: by day; orders are counted again at this grain."""
    return totals(star, "year", "month_number", "full_date").drop("tax_total", "units")


def revenue_by_region(star: DataFrame) -> DataFrame:
    """Q2: by region and month."""
    df = totals(star.where("region is not null"), "region", "year", "month_number")
    return df.select("region", "year", "month_number", "net_revenue", "orders", ratio(F.col("net_revenue"), F.col("orders")).alias("avg_order_value"))


def revenue_by_product(star: DataFrame) -> DataFrame:
    """Q3"""
    return totals(star, "category_name", "brand", "product_name").select("category_name", "brand", "product_name", F.col("units").alias("units_sold"), "net_revenue", "orders")


def average_order_value(star: DataFrame) -> DataFrame:
    """Q4: mean and median of order totals, by month, region and segment."""
    by = ["year", "month_number", "region", "customer_segment"]
    orders = sold(star).groupBy(*by, "order_id").agg(_sum("net_amount", "total"))
    df = orders.groupBy(*by).agg(F.count("*").alias("orders"), _sum("total", "net"), F.percentile_approx("total", 0.5, EXACT).alias("median_order_value"))
    return df.withColumn("avg_order_value", ratio(F.col("net"), F.col("orders"))).drop("net")


def lifetime_deciles(lifetime: DataFrame) -> DataFrame:
    """Q5: customers in tenths by value, the largest first."""
    return tiles(lifetime, "lifetime_value", "customer_id", 10, "value_decile").drop("signup_date", "is_repeat_customer")


def return_rate(star: DataFrame, returns: DataFrame) -> DataFrame:
    """Q6: a product's returned units by reason, of what was sold of it; returns are rolled up before they meet sales."""
    s = sold(star).groupBy("product_id", "category_name", "brand", "product_name").agg(F.sum("quantity").cast("bigint").alias("units_sold"))
    r = returns.groupBy("product_id", "return_reason").agg(F.sum("quantity").cast("bigint").alias("units_returned"))
    df = s.join(r, "product_id", "left").fillna(0, ["units_returned"])
    return df.withColumn("return_rate", ratio(F.col("units_returned"), F.col("units_sold")))


def stocked(inventory: DataFrame, dates: DataFrame, products: DataFrame, stores: DataFrame, by: dict[str, str] | None = None) -> DataFrame:
    """Inventory snapshots with calendar, product and store."""
    by = {"products": "product_id", "stores": "location_id"} | (by or {})
    df = dated(inventory, dates).join(products.select(by["products"], "product_name", "brand", "category_name"), by["products"], "left")
    return df.join(stores.select(by["stores"], "store_name", "region"), by["stores"], "left")


def inventory_availability(stock: DataFrame) -> DataFrame:
    """Q7: a day, store and category; quantities are averaged over snapshots, never summed over days."""
    df = stock.groupBy("full_date", "store_name", "region", "category_name").agg(F.sum("quantity_available").cast("bigint").alias("units_available"), F.count_if("is_stockout").alias("skus_out_of_stock"), F.count("*").alias("skus_tracked"))
    return df.withColumn("avg_units_per_sku", ratio(F.col("units_available"), F.col("skus_tracked")))


def stockout_frequency(stock: DataFrame, least: int = 1) -> DataFrame:
    """Q8: products that were out of stock at a store on `least` days or more."""
    df = stock.groupBy("product_id", "product_name", "brand", "store_name").agg(F.count("*").alias("days_tracked"), F.count_if("is_stockout").alias("days_out_of_stock")).where(F.col("days_out_of_stock") >= least)
    return df.withColumn("stockout_rate", ratio(F.col("days_out_of_stock"), F.col("days_tracked")))


def cohort_retention(cohorts: DataFrame) -> DataFrame:
    """Q9: customers as a share of month 0; cohorts without a month 0 have none."""
    w = Window.partitionBy("cohort_month").orderBy("months_since_signup")
    first = F.first(F.when(F.col("months_since_signup") == 0, F.col("active_customers"))).over(w)
    return cohorts.withColumn("retention", ratio(F.col("active_customers"), first))


def conversion(events: DataFrame, steps: tuple[str, str, str]) -> DataFrame:
    """Q10: sessions with a view, a cart and an order, by the day they started and their channel.

    events: session_id, channel, event_type, event_time. A session's channel is that of its first event.
    """
    flags = [F.max((F.col("event_type") == s).cast("int")).alias(n) for s, n in zip(steps, ("v", "c", "o"))]
    first = F.min(F.struct("event_time", "channel"))
    sessions = events.groupBy("session_id").agg(first.alias("first"), *flags)
    df = sessions.groupBy(F.col("first.event_time").cast("date").alias("full_date"), F.col("first.channel").alias("channel")).agg(
        *[F.sum(n).cast("bigint").alias(f"sessions_with_{name}") for n, name in (("v", "view"), ("c", "cart"), ("o", "order"))]
    )
    seen = F.col("sessions_with_view")
    return df.withColumns({"conversion_rate": ratio(F.col("sessions_with_order"), seen), "cart_rate": ratio(F.col("sessions_with_cart"), seen)})


def fulfilment_time(fulfillment: DataFrame, stores: DataFrame, by: str = "store_id") -> DataFrame:
    """Q11: hours to ship and to deliver by month and store, of shipped orders that weren't cancelled."""
    kept = fulfillment.where("order_status <> 'CANCELLED' and hours_to_ship is not null").withColumns({"year": F.year("order_date"), "month_number": F.month("order_date")})
    df = kept.join(stores.select(by, "store_name", "region"), by, "left").groupBy("year", "month_number", "store_name", "region").agg(
        F.count("*").alias("orders"),
        F.sum("hours_to_ship").cast("bigint").alias("ship"),
        F.percentile_approx("hours_to_ship", 0.95, EXACT).alias("p95_hours_to_ship"),
        F.sum("hours_to_deliver").cast("bigint").alias("deliver"),
        F.count("hours_to_deliver").alias("delivered"),
    )
    return df.withColumns({"avg_hours_to_ship": ratio(F.col("ship"), F.col("orders")), "avg_hours_to_deliver": ratio(F.col("deliver"), F.col("delivered"))}).drop("ship", "deliver", "delivered")


def promotion_impact(star: DataFrame) -> DataFrame:
    """Q12: one row a campaign, with the discount it really gave."""
    df = totals(star.where("promotion_name is not null"), "promotion_name", "promo_type", "discount_value").drop("tax_total").withColumnRenamed("discount_total", "discount_given")
    gross = F.nullif(F.col("gross_revenue").cast("double"), F.lit(0.0))
    return df.withColumns({"effective_discount": F.col("discount_given").cast("double") / gross, "aov_on_promotion": ratio(F.col("net_revenue"), F.col("orders"))})


def latest_vs_trend(daily: DataFrame, by: str = "region", day: str = "date_key", rows: int = 28) -> DataFrame:
    """Q13: each day's revenue beside the mean of the `rows` days before it, and by how much it differs."""
    w = Window.partitionBy(by).orderBy(day).rowsBetween(-rows, -1)
    mean = F.sum("net_revenue").over(w).cast("double") / F.nullif(F.count("*").over(w), F.lit(0).cast("bigint"))
    df = daily.select(by, day, "net_revenue", "orders", mean.alias("trailing_mean"))
    return df.withColumn("variance", (F.col("net_revenue").cast("double") - F.col("trailing_mean")) / F.nullif("trailing_mean", F.lit(0.0)))


def executive_kpis(sales: DataFrame, lifetime: DataFrame, performance: DataFrame) -> DataFrame:
    """One row: revenue, orders and their mean, customers and how many came again, units returned of units sold."""
    orders = sold(sales).groupBy("order_id").agg(F.sum("net_amount").alias("net"))
    s = orders.agg(_sum("net", "total_net_revenue"), F.count("*").alias("total_orders"))
    c = lifetime.agg(F.count("*").alias("customers_with_orders"), F.count_if("is_repeat_customer").alias("repeat_customers"))
    r = performance.agg(F.sum("units_returned").alias("back"), F.sum("units_sold").alias("out")).select(ratio(F.col("back"), F.col("out")).alias("return_rate"))
    return s.join(F.broadcast(c)).join(F.broadcast(r)).withColumn("avg_order_value", ratio(F.col("total_net_revenue"), F.col("total_orders")))


# --- operations -------------------------------------------------------------------------------------


def run_status(runs: DataFrame, since: Column) -> DataFrame:
    """Runs since a time by day, stage, entity and status: how many, seconds, rows."""
    df = runs.where(F.col("started_at") >= since).groupBy(F.to_date("started_at").alias("run_date"), "stage", "entity", "status").agg(
        F.count("*").alias("runs"), F.sum("duration_s").alias("seconds"), F.max("duration_s").alias("max_duration_s"), *[F.sum(c).cast("bigint").alias(c) for c in ("rows_in", "rows_out", "rows_quarantined")]
    )
    return df.withColumn("avg_duration_s", ratio(F.col("seconds"), F.col("runs"))).drop("seconds")


def duration_trend(runs: DataFrame, rows: int = 7) -> DataFrame:
    """Mean seconds a day of an entity's successful runs at a stage, and the mean of that over its last `rows` days."""
    daily = runs.where("status = 'SUCCESS'").groupBy("entity", "stage", F.to_date("started_at").alias("run_date")).agg(ratio(F.sum("duration_s"), F.count("*")).alias("duration_s"))
    w = Window.partitionBy("entity", "stage").orderBy("run_date").rowsBetween(-(rows - 1), 0)
    return daily.withColumn("rolling_mean", F.avg("duration_s").over(w))


def dq_summary(results: DataFrame, since: Column) -> DataFrame:
    """Each rule since a time: evaluations, failures, mean pass rate."""
    return results.where(F.col("checked_at") >= since).groupBy("entity", "rule", "type", "severity").agg(
        F.count("*").alias("evaluations"), F.count_if(F.col("status") == "FAILED").alias("failures"), F.count_if(F.col("status") == "SKIPPED").alias("skipped"), F.avg("pass_rate").alias("avg_pass_rate"), F.max("checked_at").alias("last_evaluated")
    )


def reconciliation_status(results: DataFrame, since: Column) -> DataFrame:
    """Checks since a time with both sides, their difference and what it may be."""
    kept = ["check_name", "entity", "source_layer", "target_layer", "source_value", "target_value", "difference", "tolerance", "status"]
    return results.where(F.col("checked_at") >= since).select(F.to_date("checked_at").alias("check_date"), *kept)


def freshness(runs: DataFrame, as_of: Column, warn_hours: int = 26, breach_hours: int = 48) -> DataFrame:
    """OK, WARN or BREACH by the hours since an entity last succeeded at a stage."""
    df = runs.where("status = 'SUCCESS'").groupBy("entity", "stage").agg(F.max("ended_at").alias("last_success"))
    hours = ((F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp(F.col("last_success").cast("timestamp"))) / 3600).cast("int")
    df = df.withColumn("hours_since", hours)
    return df.withColumn("status", F.when(F.col("hours_since") > breach_hours, "BREACH").when(F.col("hours_since") > warn_hours, "WARN").otherwise("OK"))


def pipeline_health(runs: DataFrame, results: DataFrame, checks: DataFrame, since: Column, as_of: Column) -> DataFrame:
    """One row: what failed since a time, and what is in breach of its freshness."""
    a = runs.where(F.col("started_at") >= since).agg(F.count_if(F.col("status") == "FAILED").alias("failed_runs"))
    b = results.where(F.col("checked_at") >= since).agg(F.count_if((F.col("severity") == "fatal") & (F.col("status") == "FAILED")).alias("fatal_failures"))
    c = checks.where(F.col("checked_at") >= since).agg(F.count_if(F.col("status") != "PASSED").alias("reconciliation_failures"))
    d = freshness(runs, as_of).agg(F.count_if(F.col("status") == "BREACH").alias("sla_breaches"))
    return a.join(F.broadcast(b)).join(F.broadcast(c)).join(F.broadcast(d))


# --- secured projections ----------------------------------------------------------------------------


def sales_summary(star: DataFrame) -> DataFrame:
    """A line a row, without any column that names a customer."""
    return star.select(*"full_date year month_name quarter region customer_segment product_name brand category_name quantity gross_amount discount_amount net_amount".split())


def inventory_health(stock: DataFrame) -> DataFrame:
    """Stock as it was; averaged over days, never summed."""
    return stock.select(*"full_date store_name region product_name brand quantity_on_hand quantity_available reorder_point is_stockout is_below_reorder".split())


def pii_inventory(tags: DataFrame) -> DataFrame:
    """A column a row: its class, kind of personal data, and whether it is masked, from the tag table."""

    def tag(name: str) -> Column:
        return F.max(F.when(F.col("tag_name") == name, F.col("tag_value"))).alias(name)

    df = tags.groupBy("table_name", "column_name").agg(tag("data_classification"), tag("pii_type"), tag("masked"))
    return df.where(F.col("data_classification").isin("P0", "P1"))
