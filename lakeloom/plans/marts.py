"""Aggregate marts. Customers and products are grouped by their business keys, not by versions; ratios
are exact sums divided once; cancelled orders count nowhere.

Orders are counted at each mart's own grain: sums go by (grain, order) first, so orders are rows of that and
no distinct count has to carry all sums through its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.operators.clustering import FACT_ROWS_A_TASK, dealt

MONEY = "decimal(18,2)"
CALENDAR = ("full_date", "year", "month_number")


def ratio(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b, F.lit(0).cast("bigint"))


def sold(sales: DataFrame) -> DataFrame:
    return sales.where(~F.col("is_cancelled"))


def dated(df: DataFrame, dates: DataFrame) -> DataFrame:
    """With the calendar's columns for date_key."""
    return df.join(dates.select("date_key", "full_date", F.col("year_number").alias("year"), "month_number", "month_name", F.col("quarter_number").alias("quarter")), "date_key", "left")


def totals(sales: DataFrame, *by: str) -> DataFrame:
    """Revenue, units and orders of what was sold."""
    amounts = {"gross_amount": "gross_revenue", "discount_amount": "discount_total", "net_amount": "net_revenue", "tax_amount": "tax_total"}
    orders = sold(sales).groupBy(*by, "order_id").agg(*[F.sum(c).alias(c) for c in amounts], F.sum("quantity").alias("quantity"))
    return orders.groupBy(*by).agg(*[F.sum(c).cast(MONEY).alias(n) for c, n in amounts.items()], F.sum("quantity").cast("bigint").alias("units"), F.count("*").alias("orders"))


def daily_sales(sales: DataFrame, by: tuple[str, ...] = (*CALENDAR, "region", "category_name")) -> DataFrame:
    """Sales a day, region and category. Orders are distinct at this grain; they don't add up across categories."""
    return totals(sales, *by).withColumn("avg_order_value", ratio(F.col("net_revenue"), F.col("orders")))


def customer_lifetime(sales: DataFrame, customers: DataFrame | None = None, as_of: Column | None = None) -> DataFrame:
    """A customer with orders, its attributes as they are now, and how long ago it last ordered."""
    orders = sold(sales).groupBy("customer_id", "order_id").agg(F.sum("net_amount").alias("net"), F.min("order_date").alias("order_date"))
    df = orders.groupBy("customer_id").agg(F.count("*").alias("total_orders"), F.sum("net").cast(MONEY).alias("lifetime_value"), F.min("order_date").cast("date").alias("first_order_date"), F.max("order_date").cast("date").alias("last_order_date"))
    df = df.withColumns(
        {
            "avg_order_value": ratio(F.col("lifetime_value"), F.col("total_orders")),
            "days_since_last_order": F.datediff(F.current_date() if as_of is None else as_of, "last_order_date"),
            "is_repeat_customer": F.col("total_orders") > 1,
        }
    )
    if customers is None:
        return df
    wanted = [c for c in ("customer_segment", "region", "signup_date") if c in customers.columns]
    return df.join(customers.select("customer_id", *wanted), "customer_id", "left")


def customer_cohort(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Active customers, orders and revenue by signup month and months since; months before signup are left out."""
    c = customers.select("customer_id", F.trunc("signup_date", "month").cast("date").alias("cohort_month"))
    df = sold(sales).join(c, "customer_id")
    months = F.months_between(F.trunc("order_date", "month"), F.col("cohort_month")).cast("int")
    df = df.withColumn("months_since_signup", months).where("months_since_signup >= 0")
    by = ["cohort_month", "months_since_signup"]
    # an order has one customer: orders, then customers, then the cohort
    one = df.groupBy(*by, "customer_id", "order_id").agg(F.sum("net_amount").alias("net")).groupBy(*by, "customer_id").agg(F.sum("net").alias("net"), F.count("*").alias("orders"))
    return one.groupBy(*by).agg(F.count("*").alias("active_customers"), F.sum("orders").cast("bigint").alias("orders"), F.sum("net").cast(MONEY).alias("net_revenue"))


def product_performance(sales: DataFrame, returns: DataFrame, products: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Sales and returns of a product a day; a return counts on the day its order was placed, so rates are of what was sold.

    Revenue on promotion is that of lines whose order names a campaign. rows: how many sales there are at most, if
    known; groups, which can be as many, are then dealt accordingly.
    """

    def spread(df: DataFrame, *key: str) -> DataFrame:
        return df if rows is None else dealt(df, key, rows, FACT_ROWS_A_TASK)

    zero = F.lit(0).cast(MONEY)
    promoted = F.when(F.col("promotion_id").isNotNull(), F.col("net_amount")).otherwise(zero) if "promotion_id" in sales.columns else zero
    orders = sold(sales).groupBy("date_key", "product_id", "order_id").agg(F.sum("quantity").alias("quantity"), F.sum("net_amount").alias("net"), F.sum(promoted).alias("promoted"))
    s = spread(orders, "date_key", "product_id").groupBy("date_key", "product_id").agg(
        F.sum("quantity").cast("bigint").alias("units_sold"), F.sum("net").cast(MONEY).alias("net_revenue"), F.count("*").alias("orders"), F.sum("promoted").cast(MONEY).alias("promo_revenue")
    )
    back = returns.select(F.date_format("order_date", "yyyyMMdd").cast("int").alias("date_key"), "product_id", "quantity")
    r = spread(back, "date_key", "product_id").groupBy("date_key", "product_id").agg(F.sum("quantity").cast("bigint").alias("units_returned"))
    df = s.join(r, ["date_key", "product_id"], "full").fillna(0, ["units_sold", "orders", "units_returned"])
    df = df.withColumns({"net_revenue": F.coalesce("net_revenue", zero), "promo_revenue": F.coalesce("promo_revenue", zero)})
    df = df.withColumn("return_rate", ratio(F.col("units_returned"), F.col("units_sold")))
    return df if products is None else spread(df, "product_id").join(products.select("product_id", "product_name", "brand"), "product_id", "left")
