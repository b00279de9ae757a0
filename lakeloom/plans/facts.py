"""Facts at their declared grain, from current silver frames.

Frames carry is_deleted; lines and orders that are soft-deleted take no part in sales and fulfilment.
Returns and payments keep their history, whatever became of the order. Money is decimal(18,2).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.functions.keys import date_key, surrogate_key
from lakeloom.operators.clustering import FACT_ROWS_A_TASK, dealt
from lakeloom.operators.scd import resolve_keys

CANCELLED = "CANCELLED"
Dimensions = dict[str, tuple[DataFrame, str, str, str]]


def money(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def active(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_deleted")) if "is_deleted" in df.columns else df


def _resolved(df: DataFrame, dimensions: Dimensions | None, event_time: str) -> DataFrame:
    return resolve_keys(df, {n: d for n, d in (dimensions or {}).items() if d[1] in df.columns}, event_time)


def fact_sales(lines: DataFrame, orders: DataFrame, dimensions: Dimensions | None = None, products: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """One order line. Cancelled orders stay, marked; metrics leave them out.

    Gross is quantity * unit_price unless the lines bring gross_amount; net is gross less discount. products
    (product_id, category_id) bring the category that neither lines nor orders have. rows: how many lines there
    are at most, if known; they are dealt by order accordingly, so what a task joins doesn't grow with the input.
    """
    brought = [c for c in ("store_id", "region", "customer_segment", "promotion_id", "payment_status") if c in orders.columns and c not in lines.columns]
    o = active(orders).select("order_id", "customer_id", "order_date", "order_status", *brought)
    gross = money("gross_amount") if "gross_amount" in lines.columns else money(money("unit_price") * F.col("quantity"))
    own = ["order_id", "order_line_number", "product_id", "quantity", *[c for c in ("promotion_id",) if c in lines.columns]]
    df = active(lines).select(*own, money("unit_price").alias("unit_price"), gross.alias("gross_amount"), money("discount_amount").alias("discount_amount"), money("tax_amount").alias("tax_amount"))
    df = df.withColumn("sales_sk", surrogate_key("order_id", "order_line_number"))
    if products is not None:
        df = df.join(products.select("product_id", "category_id"), "product_id", "left")
    df = df.withColumn("net_amount", money(F.col("gross_amount") - F.col("discount_amount")))
    if rows is not None:
        df = dealt(df, ["order_id"], rows, FACT_ROWS_A_TASK)
    df = df.join(o, "order_id").withColumn("date_key", date_key("order_date")).withColumn("is_cancelled", F.col("order_status") == CANCELLED)
    return _resolved(df, dimensions, "order_date")


def fact_order_fulfillment(orders: DataFrame, shipments: DataFrame, payments: DataFrame | None = None, returns: DataFrame | None = None, dimensions: Dimensions | None = None, lines: DataFrame | None = None) -> DataFrame:
    """One order with its milestones, lines and net amount. Everything else is rolled up first, so nothing fans out."""
    shipped = active(shipments).groupBy("order_id").agg(F.min("shipped_at").alias("shipped_at"), F.max("delivered_at").alias("delivered_at"))
    df = active(orders).join(shipped, "order_id", "left")
    if payments is not None:
        paid = payments.where("payment_status = 'CAPTURED'").groupBy("order_id").agg(F.min("paid_at").alias("paid_at"))
        df = df.join(paid, "order_id", "left")
    else:
        df = df.withColumn("paid_at", F.lit(None).cast("timestamp"))
    if returns is not None:
        back = returns.groupBy("order_id").agg(F.min("return_date").alias("returned_at"))
        df = df.join(back, "order_id", "left")
    else:
        df = df.withColumn("returned_at", F.lit(None).cast("timestamp"))

    if lines is not None:
        gross = money("gross_amount") if "gross_amount" in lines.columns else money(money("unit_price") * F.col("quantity"))
        own = active(lines).groupBy("order_id").agg(F.count("*").alias("order_line_count"), money(F.sum(gross - money("discount_amount"))).alias("order_net_amount"))
        df = df.join(own, "order_id", "left")
    else:
        df = df.withColumns({"order_line_count": F.lit(None).cast("long"), "order_net_amount": F.lit(None).cast("decimal(18,2)")})

    def hours(a: str, b: str) -> Column:
        return ((F.unix_timestamp(F.col(b).cast("timestamp")) - F.unix_timestamp(F.col(a).cast("timestamp"))) / 3600).cast("int")

    changed = "updated_at" if "updated_at" in orders.columns else "order_date"
    df = df.withColumns(
        {
            "cancelled_at": F.when(F.col("order_status") == CANCELLED, F.col(changed)),
            "hours_to_ship": hours("order_date", "shipped_at"),
            "hours_to_deliver": hours("order_date", "delivered_at"),
            "placed_at": F.col("order_date"),
            "date_key": date_key("order_date"),
            "order_fulfillment_sk": surrogate_key("order_id"),
        }
    )
    df = _resolved(df, dimensions, "order_date")
    keys = [n for n in (*(dimensions or {}), "store_id") if n in df.columns]
    return df.select(
        *"order_fulfillment_sk order_id customer_id order_date order_status date_key placed_at paid_at shipped_at delivered_at returned_at cancelled_at".split(),
        *"hours_to_ship hours_to_deliver order_line_count order_net_amount".split(),
        *keys,
    )


def fact_inventory_snapshot(inventory: DataFrame, dimensions: Dimensions | None = None) -> DataFrame:
    """A product at a place on a day. Quantities don't add up over days: average them."""
    df = inventory.withColumns(
        {
            "inventory_sk": surrogate_key("snapshot_date", "product_id", "location_id"),
            "date_key": date_key("snapshot_date"),
            "is_stockout": F.col("quantity_available") <= 0,
            "is_below_reorder": F.col("quantity_available") <= F.col("reorder_point"),
        }
    )
    return _resolved(df, dimensions, "snapshot_date")


def fact_returns(returns: DataFrame, orders: DataFrame, dimensions: Dimensions | None = None) -> DataFrame:
    """A returned line, with the days since its order."""
    o = orders.select("order_id", *[c for c in ("customer_id", "order_date") if c not in returns.columns])
    name = ["return_id"] if "return_id" in returns.columns else ["order_id", "order_line_number"]
    df = returns.join(o, "order_id", "left").withColumns({"return_sk": surrogate_key(*name), "date_key": date_key("return_date"), "days_to_return": F.datediff("return_date", "order_date"), "refund_amount": money("refund_amount")})
    return _resolved(df, dimensions, "return_date")


def fact_customer_events(events: DataFrame, dimensions: Dimensions | None = None) -> DataFrame:
    """An event."""
    return _resolved(events.withColumns({"event_sk": surrogate_key("event_id"), "date_key": date_key("event_time")}), dimensions, "event_time")


def fact_payment(payments: DataFrame, orders: DataFrame, dimensions: Dimensions | None = None) -> DataFrame:
    """A payment attempt; failed ones stay."""
    o = orders.select("order_id", "customer_id", "order_date")
    df = payments.join(o, "order_id", "left").withColumns({"payment_sk": surrogate_key("payment_id"), "date_key": date_key("paid_at"), "is_successful": F.col("payment_status") == "CAPTURED", "payment_amount": money("payment_amount")})
    return _resolved(df, dimensions, "paid_at")
