"""Deterministic deduplication over a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.config import ALIASES
from lakeloom.functions.keys import record_hash


def total_order(df: DataFrame, order_by: list[str] | tuple[str, ...]) -> list[Column]:
    """Latest first, NULLs last; ties end in a hash of the whole row, so only equal rows tie."""
    names = [c if c in df.columns else ALIASES.get(c, c) for c in order_by]
    known = [c for c in names if c in df.columns]
    if not known:
        raise ValueError(f"none of {', '.join(order_by)} is a column")
    tie = F.col("_record_hash") if "_record_hash" in df.columns else record_hash(sorted(c for c in df.columns if not c.startswith("_")))
    return [F.col(c).desc_nulls_last() for c in known if c != "_record_hash"] + [tie.desc()]


def deduplicate(df: DataFrame, key: list[str], order_by: list[str] | None = None, order: list[Column] | None = None, keep_counts: bool = False) -> DataFrame:
    """The first row of each key. The row number's limit runs before the shuffle as well as after."""
    w = Window.partitionBy(*key).orderBy(*(order or total_order(df, order_by or [])))
    out = df
    if keep_counts:
        out = out.withColumn("_duplicate_count", F.count("*").over(Window.partitionBy(*key)))
    return out.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def exact_duplicates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(record_hash, copies) of rows that occur more than once."""
    return df.groupBy(record_hash(columns).alias("record_hash")).agg(F.count("*").alias("copies")).where("copies > 1")


def dedup_report(df: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Rows, distinct keys, and what was repeated by key and exactly: one row, one scan.

    Distinct rows are counted as they are, then by key; NULLs are equal to each other. Both steps aggregate before
    their shuffles, so neither a row nor a key that comes very often makes a large task.
    """
    rows = df.groupBy(*columns).agg(F.count("*").alias("_copies"))
    keys = rows.groupBy(*key).agg(F.count("*").alias("_rows"), F.sum("_copies").alias("_copies"))
    one = keys.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows_in"), F.count("*").alias("distinct_keys"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("distinct_rows"))
    return one.select("rows_in", "distinct_keys", (F.col("rows_in") - F.col("distinct_keys")).alias("duplicate_rows"), (F.col("rows_in") - F.col("distinct_rows")).alias("exact_duplicates"))
