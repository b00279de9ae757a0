"""Canonical strings: trimmed, empty is NULL, codes upper case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Columns whose names end so hold codes.
CODE_ENDINGS = ("_status", "_type", "_segment", "_method", "_reason", "state", "country", "currency", "region", "channel", "status")


def standardise(df: DataFrame, exclude: tuple[str, ...] = (), codes: tuple[str, ...] = CODE_ENDINGS) -> DataFrame:
    """Drops excluded columns, then tidies every string column but system columns (with a leading _)."""
    tidy = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and f.name not in exclude and not f.name.startswith("_"):
            value = F.nullif(F.trim(F.col(f.name)), F.lit(""))
            tidy[f.name] = F.upper(value) if f.name.endswith(codes) else value
    kept = df.drop(*exclude)
    return kept.withColumns(tidy) if tidy else kept
