"""Source-to-target checks. Each gives one row: check_name, entity, source_value, target_value, difference, status."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.plans.facts import CANCELLED

MONEY_TOLERANCE = Decimal("0.01")
DELETE_LIMIT = 0.25


#: Layers that a check compares, and how far its sides may differ.
SIDES = {"row_flow": ("bronze", "silver", 0), "soft_delete_rate": ("silver", "silver", 0), "net_revenue": ("silver", "gold", MONEY_TOLERANCE), "grain": ("gold", "gold", 0), "surrogate_key": ("gold", "gold", 0), "control_totals": ("source", "gold", MONEY_TOLERANCE)}


def result(one: DataFrame, check: str, entity: str, source: Column, target: Column, ok: Column) -> DataFrame:
    return one.select(
        F.lit(check).alias("check_name"),
        F.lit(entity).alias("entity"),
        source.cast("decimal(18,2)").alias("source_value"),
        target.cast("decimal(18,2)").alias("target_value"),
        (source.cast("decimal(18,2)") - target.cast("decimal(18,2)")).cast("decimal(18,2)").alias("difference"),
        F.when(ok, "PASSED").otherwise("FAILED").alias("status"),
    )


def row_flow(entity: str, bronze: DataFrame, silver: DataFrame, quarantine: DataFrame, key: list[str]) -> DataFrame:
    """Every key that came in is in silver or in quarantine: how many came, and how many of those are there.

    Distinct keys count (NULL is one), so reruns don't add up; keys that never came don't make up for lost ones.
    """
    side = lambda df, came, there: df.select(*key, F.lit(came).alias("_came"), F.lit(there).alias("_there"))
    both = side(bronze, 1, 0).unionByName(side(silver, 0, 1)).unionByName(side(quarantine, 0, 1))
    one = both.groupBy(*key).agg(F.max("_came").alias("_came"), F.max("_there").alias("_there")).where("_came = 1").agg(F.count("*").alias("a"), F.coalesce(F.sum("_there"), F.lit(0)).alias("b"))
    return result(one, "row_flow", entity, F.col("a"), F.col("b"), F.col("a") == F.col("b"))


def soft_delete_rate(entity: str, silver: DataFrame, limit: float = DELETE_LIMIT) -> DataFrame:
    one = silver.agg(F.count("*").alias("a"), F.count_if("is_deleted").alias("b"))
    return result(one, "soft_delete_rate", entity, F.col("a"), F.col("b"), F.col("b") <= F.col("a") * limit)


def money(lines: DataFrame, orders: DataFrame, sales: DataFrame, tolerance: Decimal = MONEY_TOLERANCE) -> DataFrame:
    """Net revenue without cancelled orders: in silver, and in the fact."""
    live = orders.where(F.col("order_status") != CANCELLED).select("order_id")
    a = lines.join(live, "order_id").agg(F.coalesce(F.sum(F.col("gross_amount") - F.col("discount_amount")), F.lit(0)).alias("a"))
    b = sales.where(~F.col("is_cancelled")).agg(F.coalesce(F.sum("net_amount"), F.lit(0)).alias("b"))
    return result(a.join(F.broadcast(b)), "net_revenue", "fact_sales", F.col("a"), F.col("b"), F.abs(F.col("a") - F.col("b")) <= F.lit(tolerance))


def grain(name: str, fact: DataFrame, key: list[str]) -> DataFrame:
    """As many rows as keys."""
    n = fact.groupBy(*key).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("a"), F.count("*").alias("b"))
    return result(n, "grain", name, F.col("a"), F.col("b"), F.col("a") == F.col("b"))


def surrogate_keys(name: str, dimension: DataFrame, column: str) -> DataFrame:
    """A dimension's key is never NULL and never twice."""
    one = dimension.agg(F.count("*").alias("a"), F.countDistinct(column).alias("b"))
    return result(one, "surrogate_key", name, F.col("a"), F.col("b"), F.col("a") == F.col("b"))


def control_totals(sales: DataFrame, totals: dict, planted: dict | None = None, tolerance: Decimal = MONEY_TOLERANCE) -> DataFrame:
    """Net revenue against the generator's, less what its planted defects take away."""
    expected = Decimal(str(totals["net_revenue"])) - Decimal(str((planted or {}).get("net_revenue", 0)))
    one = sales.where(~F.col("is_cancelled")).agg(F.coalesce(F.sum("net_amount"), F.lit(0)).alias("b"))
    a = F.lit(expected).cast("decimal(18,2)")
    return result(one, "control_totals", "fact_sales", a, F.col("b"), F.abs(a - F.col("b")) <= F.lit(tolerance))


def run_all(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
