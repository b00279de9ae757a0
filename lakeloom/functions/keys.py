"""Surrogate keys, record hashes and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Between parts of a key, and in place of NULL: neither occurs in business data.
SEPARATOR, NULL = "\x01", "␀"
UNKNOWN = -1
#: End of an open validity interval, and start of a key's first version.
OPEN_END, BEGINNING = "9999-12-31 23:59:59", "1900-01-01 00:00:00"


def _parts(columns) -> Column:
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.trim(F.col(c).cast("string") if isinstance(c, str) else c.cast("string")), F.lit(NULL)) for c in columns])


def surrogate_key(*columns) -> Column:
    """64-bit key of a business key; NULL parts and shifted parts give different keys."""
    return F.xxhash64(_parts(columns))


def versioned_key(business_key, start) -> Column:
    """Key of one version of a business key (one column or several)."""
    keys = [business_key] if isinstance(business_key, (str, Column)) else list(business_key)
    return F.xxhash64(_parts([*keys, start]))


def record_hash(columns) -> Column:
    """SHA-256 of a row's columns, in the given order."""
    return F.sha2(_parts(columns), 256)


def date_key(column) -> Column:
    """yyyyMMdd as an integer."""
    return F.date_format(column, "yyyyMMdd").cast("int")


def unknown_member() -> Column:
    return F.lit(UNKNOWN).cast("bigint")
