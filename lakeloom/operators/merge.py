"""Merging changes into a current state, as pure frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SILVER = ("is_deleted", "deleted_at", "_silver_updated_at")


def with_soft_delete(df: DataFrame, as_of: Column) -> DataFrame:
    """Adds is_deleted, deleted_at and _silver_updated_at; rows without _is_delete are live."""
    gone = F.coalesce(F.col("_is_delete"), F.lit(False)) if "_is_delete" in df.columns else F.lit(False)
    return df.withColumns({"is_deleted": gone, "deleted_at": F.when(gone, as_of), "_silver_updated_at": as_of})


def newer(source: dict[str, Column], target: dict[str, Column], watermark: str | None) -> Column:
    """Whether a source row replaces the target's: by log position if there is one, else by watermark.

    An unknown position on the target's side never blocks an update; without either, the source wins.
    """
    if "_source_lsn" in source and "_source_lsn" in target:
        return target["_source_lsn"].isNull() | (source["_source_lsn"] >= target["_source_lsn"])
    if watermark and watermark in source and watermark in target:
        return target[watermark].isNull() | (source[watermark] >= target[watermark])
    return F.lit(True)


def merge(target: DataFrame, source: DataFrame, key: list[str], watermark: str | None = None, always: bool = False) -> DataFrame:
    """Target with source merged in: newer rows replace, new keys join, others stay.

    The source must have one row a key. Keys compare NULL-safely. New columns of the source are added;
    columns that only the target has are NULL in replaced and new rows.
    """
    return merge_marked(target, source, key, watermark, always).drop("_merge_kind")


def merge_marked(target: DataFrame, source: DataFrame, key: list[str], watermark: str | None = None, always: bool = False) -> DataFrame:
    """As merge, and _merge_kind: what became of each row (inserted, updated, ignored for a source row that is too old, else NULL).

    Columns of the source whose names begin with _merge_ go along with its rows.
    """
    own = [c for c in source.columns if not c.startswith("_merge_")]
    columns = list(dict.fromkeys([*target.columns, *own]))
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_in_s"))
    same = reduce(lambda a, b: a & b, [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in key])
    old, new = {c: F.col(f"t_{c}") for c in target.columns}, {c: F.col(f"s_{c}") for c in own}
    replaces = F.lit(True) if always else newer(new, old, watermark)
    wins = F.coalesce(replaces, F.lit(False))
    takes = F.col("_in_s").isNotNull() & (F.col("_in_t").isNull() | wins)
    kinds = dict(source.dtypes) | dict(target.dtypes)
    none = {c: F.lit(None).cast(k) for c, k in kinds.items()}
    kind = F.when(F.col("_in_s").isNull(), None).when(F.col("_in_t").isNull(), "inserted").when(wins, "updated").otherwise("ignored")
    extra = [F.col(f"s_{c}").alias(c) for c in source.columns if c not in own]
    return t.join(s, same, "full").select(*[F.when(takes, new.get(c, none[c])).otherwise(old.get(c, none[c])).alias(c) for c in columns], kind.alias("_merge_kind"), *extra)


def merge_metrics(target: DataFrame, source: DataFrame, key: list[str], watermark: str | None = None) -> DataFrame:
    """One row: how many rows a merge inserts and updates, and how many source rows are too old."""
    same = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in key])
    old, new = {c: F.col(f"t.{c}") for c in target.columns}, {c: F.col(f"s.{c}") for c in source.columns}
    joined = source.alias("s").join(target.withColumn("_in_t", F.lit(True)).alias("t"), same, "left")
    absent = F.col("_in_t").isNull()
    wins = F.coalesce(newer(new, old, watermark), F.lit(False))
    return joined.agg(F.count_if(absent).alias("inserted"), F.count_if(~absent & wins).alias("updated"), F.count_if(~absent & ~wins).alias("ignored"))


def snapshot_deletes(target: DataFrame, snapshot: DataFrame, key: list[str], as_of: Column) -> DataFrame:
    """A full load's state: the snapshot's rows, and live target rows that it lacks, soft-deleted."""
    gone = target.join(snapshot.select(*key).distinct(), key, "left_anti").where(~F.col("is_deleted"))
    before = target.join(snapshot.select(*key).distinct(), key, "left_anti").where("is_deleted")
    gone = gone.withColumns({"is_deleted": F.lit(True), "deleted_at": as_of, "_silver_updated_at": as_of})
    return with_soft_delete(snapshot, as_of).unionByName(gone, allowMissingColumns=True).unionByName(before, allowMissingColumns=True)


def carry_deletes(dimension: DataFrame, gone: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """The dimension with is_deleted on the current version of deleted keys.

    gone has the keys of which that is known now, and _gone; of others what `before` (the versions as they
    were) says holds on.
    """
    key = [c for c in gone.columns if c != "_gone"]
    out = dimension.drop("is_deleted").join(gone, key, "left")
    if before is not None and "is_deleted" in before.columns:
        was = before.groupBy(*key).agg(F.bool_or(F.coalesce("is_deleted", F.lit(False))).alias("_was"))
        out = out.join(was, key, "left").withColumn("_gone", F.coalesce("_gone", "_was")).drop("_was")
    return out.withColumn("is_deleted", F.coalesce("_gone", F.lit(False)) & F.col("is_current")).drop("_gone")


def snapshot_diff(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Changes between two versions of a table: rows of `after` that are new or differ, and rows that are gone."""
    columns = list(after.columns)
    values = [c for c in columns if c not in key]
    same = reduce(lambda a, b: a & b, [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in key])
    joined = before.withColumn("_b", F.lit(True)).alias("b").join(after.withColumn("_a", F.lit(True)).alias("a"), same, "full")
    differs = reduce(lambda a, b: a | b, [~F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}")) for c in values if c in before.columns], F.lit(False))
    kind = F.when(F.col("_b").isNull(), "insert").when(F.col("_a").isNull(), "delete").when(differs, "update")
    row = [F.when(F.col("_a").isNull(), F.col(f"b.{c}") if c in before.columns else F.lit(None)).otherwise(F.col(f"a.{c}")).alias(c) for c in columns]
    return joined.select(*row, kind.alias("_change_type")).where(F.col("_change_type").isNotNull())
