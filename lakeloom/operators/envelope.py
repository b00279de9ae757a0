"""Change-event envelopes: {op, ts_ms, before, after, source}."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_envelope(df: DataFrame) -> bool:
    """Whether a frame has the structure of change events."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return "op" in kinds and all(isinstance(kinds.get(c), T.StructType) for c in ("before", "after"))


def unwrap(df: DataFrame, primary_key: list[str] | tuple[str, ...]) -> DataFrame:
    """One flat row an event: each column from the new image, or where that has none from the old one.

    Tombstones (no image) go.
    Adds _op, _source_lsn, _source_ts_ms, _is_delete, _is_snapshot; other top-level columns stay.
    """
    images = {c: df.schema[c].dataType for c in ("before", "after")}
    names = list(dict.fromkeys([*images["after"].names, *images["before"].names]))
    missing = [c for c in primary_key if c not in names]
    if missing:
        raise ValueError(f"the events have no key column {', '.join(missing)}")

    def image(name: str) -> Column:
        parts = [F.col(side)[name] for side in ("after", "before") if name in images[side].names]
        return F.coalesce(*parts).alias(name)

    source = df.schema["source"].dataType.names if "source" in df.columns else []
    lsn = F.col("source")["lsn"].cast("long") if "lsn" in source else F.lit(None).cast("long")
    snapshot = F.coalesce(F.col("source")["snapshot"].cast("string"), F.lit("false")) if "snapshot" in source else F.lit("false")
    kept = [c for c in df.columns if c not in ("op", "ts_ms", "before", "after", "source", "_rescued_data", *names)]
    return df.where("after is not null or before is not null").select(
        *[image(n) for n in names],
        *kept,
        F.col("op").alias("_op"),
        lsn.alias("_source_lsn"),
        F.col("ts_ms").cast("long").alias("_source_ts_ms"),
        (F.col("op") == "d").alias("_is_delete"),
        ((F.col("op") == "r") | snapshot.isin("true", "last")).alias("_is_snapshot"),
    )


def changed_columns(before: dict[str, Column], after: dict[str, Column]) -> Column:
    """Names of the columns whose values differ, NULLs compared as values."""
    return F.array_compact(F.array(*[F.when(~before[c].eqNullSafe(after[c]), F.lit(c)) for c in before]))


def before_after_diff(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds _changed_columns to change events."""
    return df.withColumn("_changed_columns", changed_columns({c: F.col("before")[c] for c in columns}, {c: F.col("after")[c] for c in columns}))


def split_deletes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that live, rows that delete."""
    return df.where(~F.col("_is_delete")), df.where("_is_delete")
