"""Slowly changing dimensions and as-of lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.keys import BEGINNING, OPEN_END, record_hash, surrogate_key, unknown_member, versioned_key

#: Column of a dimension: the instants of all deliveries of a version.
SEEN = "_seen"
#: Seconds of a slice of the as-of join.
SLICE = 30 * 86_400


def scd1(df: DataFrame, entity: str, key: list[str], as_of: Column) -> DataFrame:
    """Type 1 rows: the surrogate key `<entity>_sk` and _dim_updated_at added."""
    return df.withColumns({f"{entity}_sk": surrogate_key(*key), "_dim_updated_at": as_of})


def scd2(changes: DataFrame, key: list[str], tracked: list[str], changed_at: str, entity: str | None = None) -> DataFrame:
    """Versions from a stream of changes (any order, several a key).

    A row opens a version if a tracked column differs from the row before it; the version ends where
    the next one starts (half-open), the last one never. The first version of a key starts at the
    beginning of time, so facts before the first delivery still find it. SEEN holds the instants of all
    deliveries of a version, those that changed nothing too: what a change that comes late needs to know.
    """
    kind = dict(changes.dtypes)[changed_at]
    sliced = _sliced(changes.withColumn(SEEN, F.array(changed_at)), key, tracked, changed_at)
    ends = Window.partitionBy(*key).orderBy(changed_at)
    out = sliced.withColumns(
        {
            "effective_start_ts": F.when(F.lag(changed_at).over(ends).isNull(), F.lit(BEGINNING).cast(kind)).otherwise(F.col(changed_at)),
            "effective_end_ts": F.coalesce(F.lead(changed_at).over(ends), F.lit(OPEN_END).cast(kind)),
            "is_current": F.lead(changed_at).over(ends).isNull(),
            "is_inferred": F.lit(False),
        }
    )
    return out.withColumn(f"{entity}_sk", versioned_key(key, "effective_start_ts")) if entity else out


def _sliced(changes: DataFrame, key: list[str], tracked: list[str], changed_at: str) -> DataFrame:
    """The changes that open a version, with the instants (SEEN) of all that belong to it."""
    state = changes.withColumn("_scd_hash", record_hash(tracked))
    # of changes at one instant the last by hash counts, whatever their order of arrival
    instant = Window.partitionBy(*key, changed_at).orderBy(F.desc("_scd_hash"))
    state = state.withColumn("_rn", F.row_number().over(instant)).where("_rn = 1").drop("_rn")
    order = Window.partitionBy(*key).orderBy(changed_at)
    before = F.lag("_scd_hash").over(order)
    state = state.withColumn("_opens", before.isNull() | (before != F.col("_scd_hash")))
    state = state.withColumn("_run", F.count_if("_opens").over(order))
    run = Window.partitionBy(*key, "_run").orderBy(changed_at).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    state = state.withColumn(SEEN, F.flatten(F.collect_list(SEEN).over(run)))
    return state.where("_opens").drop("_opens", "_run")


def boundary_slices(dimension: DataFrame, changes: DataFrame, key: list[str], tracked: list[str], changed_at: str, entity: str | None = None) -> DataFrame:
    """All versions of the keys that changes touch, made of those versions and the changes alone.

    Only versions near a key's changes are sliced again: from the one that holds (or ends at) its first change
    to the one after its last; versions before and after stay as they are. Hidden deliveries come back from
    SEEN, so the result is what all deliveries together would give; columns that aren't tracked stay those of
    the delivery that opened the version.
    """
    kind = dict(changes.dtypes)[changed_at]
    span = changes.groupBy(*key).agg(F.min(changed_at).alias("_low"), F.max(changed_at).alias("_high"))
    old = dimension.where(~F.col("is_inferred")).join(span, key)
    order = Window.partitionBy(*key).orderBy("effective_start_ts")
    near = (F.col("effective_end_ts") >= F.col("_low")) & (F.coalesce(F.lag("effective_start_ts").over(order), F.lit(BEGINNING).cast(kind)) <= F.col("_high"))
    old = old.withColumn("_near", near).drop("_low", "_high")
    whole = Window.partitionBy(*key)
    edge = lambda c: F.when(F.col("_near"), F.col(c))
    old = old.withColumns({"_from": F.min(edge("effective_start_ts")).over(whole), "_to": F.max(edge("effective_end_ts")).over(whole)})

    columns = [c for c in changes.columns if c in dimension.columns or c in (changed_at, *key)]
    again = old.where("_near").select(*[c for c in columns if c != changed_at], F.explode(SEEN).alias(changed_at), "_from", "_to").select(*columns, "_from", "_to")
    new = changes.select(*columns, F.lit(None).cast(kind).alias("_from"), F.lit(None).cast(kind).alias("_to"))
    both = again.unionByName(new).withColumn(SEEN, F.array(changed_at))
    both = both.withColumns({"_from": F.coalesce(F.min("_from").over(whole), F.lit(BEGINNING).cast(kind)), "_to": F.coalesce(F.max("_to").over(whole), F.lit(OPEN_END).cast(kind))})
    ends = Window.partitionBy(*key).orderBy(changed_at)
    sliced = _sliced(both, key, tracked, changed_at).withColumns(
        {
            "effective_start_ts": F.when(F.lag(changed_at).over(ends).isNull(), F.col("_from")).otherwise(F.col(changed_at)),
            "effective_end_ts": F.coalesce(F.lead(changed_at).over(ends), F.col("_to")),
            "is_inferred": F.lit(False),
        }
    )
    sliced = sliced.withColumn("is_current", F.col("effective_end_ts") == F.lit(OPEN_END).cast(kind)).drop("_from", "_to")
    if entity:
        sliced = sliced.withColumn(f"{entity}_sk", versioned_key(key, "effective_start_ts"))
    return old.where("not _near").drop("_near", "_from", "_to").unionByName(sliced, allowMissingColumns=True)


def apply_scd2(dimension: DataFrame, changes: DataFrame, key: list[str], tracked: list[str], changed_at: str, entity: str | None = None) -> DataFrame:
    """A dimension with more changes, also late ones: touched keys by boundary_slices, others stay as they are."""
    again = boundary_slices(dimension, changes, key, tracked, changed_at, entity)
    return dimension.join(changes.select(*key).distinct(), key, "left_anti").select(*dimension.columns).unionByName(again, allowMissingColumns=True)


def add_inferred_members(dimension: DataFrame, facts: DataFrame, key: str, entity: str) -> DataFrame:
    """The dimension with a placeholder for each key that facts name and it lacks."""
    missing = facts.select(key).where(F.col(key).isNotNull()).distinct().join(dimension.select(key).distinct(), key, "left_anti")
    kind = dict(dimension.dtypes)["effective_start_ts"]
    rows = missing.select(
        key,
        F.lit(BEGINNING).cast(kind).alias("effective_start_ts"),
        F.lit(OPEN_END).cast(kind).alias("effective_end_ts"),
        F.lit(True).alias("is_current"),
        F.lit(True).alias("is_inferred"),
    ).withColumn(f"{entity}_sk", versioned_key(key, "effective_start_ts"))
    out = dimension.unionByName(rows, allowMissingColumns=True)
    return out.withColumn("is_deleted", F.coalesce("is_deleted", F.lit(False))) if "is_deleted" in out.columns else out


def as_of_join(facts: DataFrame, dimension: DataFrame, key: str | list[str], event_time: str, columns: list[str], slice_seconds: int = SLICE) -> DataFrame:
    """Facts with columns of the version that held at event_time (start <= t < end); none: NULL.

    Facts and versions are one stream by key and time, cut into slices of time; in each slice the last version
    is carried forward, and what a slice begins with comes from the slices before it, by one row a slice. So a
    fact meets one version however many its key has, and a key with very many facts is as many tasks' work as
    it has slices. Versions of a key don't overlap. Intervals are compared in the facts' time type; facts
    without a key or time find none.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kind = dict(facts.dtypes)[event_time]
    wanted = [c for c in columns if c not in keys]
    names = [f"_k{i}" for i in range(len(keys))]
    # keys meet in the facts' types
    kinds = dict(facts.dtypes)
    version = F.struct(F.col("effective_start_ts").cast(kind).alias("_from"), F.col("effective_end_ts").cast(kind).alias("_to"), *[F.col(c) for c in wanted])
    d = dimension.select(*[F.col(k).cast(kinds[k]).alias(n) for k, n in zip(keys, names)], F.col("effective_start_ts").cast(kind).alias("_t"), version.alias("_v"))
    d = d.where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, event_time)])
    f = facts.where(known).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(event_time).alias("_t"), F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_f"))
    part = F.floor(F.unix_seconds(F.col("_t").cast("timestamp")) / slice_seconds).alias("_slice")
    both = f.unionByName(d, allowMissingColumns=True).select("*", part)

    slice_ = Window.partitionBy(*names, "_slice").orderBy("_t", F.col("_f").isNotNull())
    carried = both.withColumn("_v", F.last("_v", ignorenulls=True).over(slice_)).where("_f is not null")
    # a row for each slice with facts or versions: the last version of the slices before
    lasts = both.groupBy(*names, "_slice").agg(F.max_by("_v", F.when(F.col("_f").isNull(), F.col("_t"))).alias("_last"), F.count("_f").alias("_facts"))
    past = Window.partitionBy(*names).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = lasts.withColumn("_before", F.last("_last", ignorenulls=True).over(past)).where("_facts > 0").select(*names, "_slice", "_before")
    v = F.coalesce("_v", "_before")
    found = carried.join(before, [*names, "_slice"]).select("_f", v.alias("_v"))
    out = found.select("_f.*", *[F.when(F.col("_f")[event_time] < F.col("_v._to"), F.col("_v")[c]).alias(c) for c in wanted])
    nobody = facts.where(~known).withColumns({c: F.lit(None).cast(t) for c, t in dict(dimension.select(*wanted).dtypes).items()}) if wanted else facts.where(~known)
    return out.unionByName(nobody)


def resolve_keys(facts: DataFrame, dimensions: dict[str, tuple[DataFrame, str, str, str]], event_time: str) -> DataFrame:
    """Adds a surrogate key for each dimension: name -> (frame, business key, its key column, scd1 or scd2); unknown: -1."""
    for name, (dimension, key, column, kind) in dimensions.items():
        if kind == "scd2":
            facts = as_of_join(facts, dimension, key, event_time, [column])
        else:
            facts = facts.join(dimension.select(F.col(key).alias("_key"), column), F.col(key) == F.col("_key"), "left").drop("_key")
        facts = facts.withColumn(column, F.coalesce(column, unknown_member())).withColumnRenamed(column, name)
    return facts
