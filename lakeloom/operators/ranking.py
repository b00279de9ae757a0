"""Ranks over one order of all rows, without one task that sorts them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.sources.staging import staged


def _dealt(df: DataFrame, value: str, tie: str) -> tuple[DataFrame, DataFrame]:
    """df in ranges of (value, tie), numbered by _part, and a row for each: its rows and those before it.

    df is computed once. The ranges are written down, as another run would sample other ones; their number is
    that of shuffle partitions, so it grows as the session is set for its data.
    """
    once = staged(df, "ranked")
    ranges = once.repartitionByRange(F.col(value).desc_nulls_last(), F.col(tie)).withColumn("_part", F.spark_partition_id())
    ranges = staged(ranges, "ranges")
    counts = ranges.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a range
    return ranges, counts.withColumn("_before", before)


def _placed(ranges: DataFrame, counts: DataFrame, value: str, tie: str, out: str) -> DataFrame:
    within = Window.partitionBy("_part").orderBy(F.col(value).desc_nulls_last(), tie)
    placed = ranges.withColumn("_within", F.row_number().over(within)).join(F.broadcast(counts.drop("_n")), "_part")
    return placed.withColumn(out, F.col("_before") + F.col("_within")).drop("_part", "_before", "_within")


def ranked(df: DataFrame, value: str, tie: str, out: str) -> DataFrame:
    """df with its rank from 1 by value, the largest first, NULL last, then by tie.

    Rows are ranked within their range, after all rows of the ranges before. Where the cuts lie changes no rank;
    rows of one value are cut by tie, so a value that very many rows have isn't one task's.
    """
    ranges, counts = _dealt(df, value, tie)
    return _placed(ranges, counts, value, tie, out)


def tiles(df: DataFrame, value: str, tie: str, n: int, out: str) -> DataFrame:
    """df in n tiles by value, the largest first; the first tiles hold one row more where n doesn't divide."""
    ranges, counts = _dealt(df, value, tie)
    rows = counts.agg(F.sum("_n").alias("_rows"))
    got = _placed(ranges, counts, value, tie, "_rank").join(F.broadcast(rows))
    small, more = F.floor(F.col("_rows") / n), F.col("_rows") % n
    wide = more * (small + 1)  # rows of the larger tiles
    tile = F.when(F.col("_rank") <= wide, F.floor((F.col("_rank") - 1) / (small + 1)) + 1).otherwise(more + F.floor((F.col("_rank") - 1 - wide) / F.greatest(small, F.lit(1))) + 1)
    return got.withColumn(out, tile.cast("int")).drop("_rank", "_rows")
