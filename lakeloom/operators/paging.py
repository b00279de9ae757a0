"""Keyset pagination: a page is a bounded top-k after a key, whatever came before it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, keys: list[str], size: int, after: tuple | None = None) -> DataFrame:
    """The first `size` rows in order of the keys (unique together, not NULL) after the given key values."""
    if after is not None:
        steps = [reduce(lambda a, b: a & b, [F.col(k) == F.lit(v) for k, v in zip(keys[:i], after)], F.col(keys[i]) > F.lit(after[i])) for i in range(len(keys))]
        df = df.where(reduce(lambda a, b: a | b, steps))
    return df.orderBy(*keys).limit(size)


def last_key(page_: DataFrame, keys: list[str]) -> tuple | None:
    """The key to go on after; None if the page is empty."""
    rows = page_.orderBy(*[F.desc(k) for k in keys]).limit(1).select(*keys).collect()
    return tuple(rows[0]) if rows else None
