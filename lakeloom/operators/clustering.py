"""Files in which rows that are near in several keys lie together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a key's range number.
BITS = 8
#: Rows that a task takes where they are sorted by key.
ROWS_A_TASK = 40_000
#: The same for the narrower rows of facts and marts, which are sorted and aggregated.
FACT_ROWS_A_TASK = 100_000


def dealt(df: DataFrame, key: list[str] | tuple[str, ...], rows: int | None = None, a_task: int | None = None) -> DataFrame:
    """df by a hash of the key in as many partitions as its rows need; few rows stay as they lie.

    Windows and joins by key that follow keep to these partitions, so what a task sorts doesn't grow with the
    input. Spark's own partitions go by compressed bytes, and rows of provenance are many times longer in memory.
    rows: how many df has at most; not given, they are counted, which for a table takes its footers alone.
    """
    n = -(-(df.count() if rows is None else rows) // (a_task or ROWS_A_TASK))
    return df.repartition(n, *[F.col(k) for k in key]) if n > 1 else df


def range_number(df: DataFrame, column: str, bits: int = BITS) -> Column:
    """The range of a column's value, of 2^bits ranges that hold about as many rows each; NULL is the first.

    Numbers, dates and times are cut at approximate quantiles (one aggregate, as many values as ranges);
    other types by the order of their first bytes.
    """
    n, kind = 1 << bits, dict(df.dtypes)[column]
    if kind == "string" or kind == "binary":
        first = F.conv(F.hex(F.rpad(F.substring(F.col(column).cast("binary"), 1, 6), 6, F.lit(b"\0"))), 16, 10).cast("double")
    elif kind == "date":
        first = F.unix_date(column).cast("double")
    elif kind == "timestamp_ntz":
        first = F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    elif kind == "timestamp":
        first = F.unix_micros(column).cast("double")
    else:
        first = F.col(column).cast("double")
    cuts = df.agg(F.percentile_approx(first, [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return F.lit(0)
    beyond = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= first))
    return F.when(F.col(column).isNull(), 0).otherwise(beyond)


def interleaved(numbers: list[Column], bits: int = BITS) -> Column:
    """Z-order: the bits of all numbers in turn, the highest first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for k, x in enumerate(numbers):
            bit = F.shiftright(x.cast("int"), b).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b * len(numbers) + (len(numbers) - 1 - k)))
    return out


def clustered(df: DataFrame, keys: list[str], files: int | None = None) -> DataFrame:
    """df in ranges of one key, or of several along a space-filling curve, sorted within them.

    With one key ranges follow it. With more, each file holds a stretch of the curve, so the statistics of its
    footer are narrow in each key, not in the first alone.
    """
    if len(keys) == 1:
        return (df.repartitionByRange(files, keys[0]) if files else df.repartitionByRange(keys[0])).sortWithinPartitions(keys[0])
    names = []
    for i, k in enumerate(keys):
        names.append(f"_merge_range{i}")
        df = df.withColumn(names[-1], range_number(df, k))
    df = df.withColumn("_merge_z", interleaved([F.col(n) for n in names])).drop(*names)
    dealt = df.repartitionByRange(files, "_merge_z") if files else df.repartitionByRange("_merge_z")
    return dealt.sortWithinPartitions("_merge_z").drop("_merge_z")
