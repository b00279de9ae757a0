"""Conformed dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions.keys import date_key

CALENDAR = (dt.date(2023, 1, 1), dt.date(2028, 12, 31))


def dim_date(spark: SparkSession, start: dt.date = CALENDAR[0], end: dt.date = CALENDAR[1]) -> DataFrame:
    """A row a day; weeks start on Sunday as day 1, the fiscal year on 1 February."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("full_date"))
    d = F.col("full_date")
    fiscal = F.add_months(d, -1)
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_number"),
        F.year(d).alias("year_number"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.concat(F.year(d).cast("string"), F.lit("-"), F.lpad(F.month(d).cast("string"), 2, "0")).alias("year_month"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.year(fiscal).alias("fiscal_year"),
    )


def conform_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    """Products with their category's key (-1 if unknown); a key from an earlier run is replaced."""
    keys = categories.select("category_id", F.col("categories_sk").alias("category_sk"))
    joined = products.drop("category_sk").join(keys, "category_id", "left")
    return joined.withColumn("category_sk", F.coalesce("category_sk", F.lit(-1).cast("bigint")))
