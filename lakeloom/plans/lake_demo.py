"""Two deliveries of a full load through the stages, over the driver's parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.config import Entity, Environment, Rule, Source
from lakeloom.operators.scd import apply_scd2, scd2
from lakeloom.plans import runner
from lakeloom.plans.audit import Audit
from lakeloom.sources.staging import shared_folder
from lakeloom.sources.tablestore import Table
from lakeloom.streaming.ingest import ingest_entity, read_bronze

RULES = [Rule(name="price_not_negative", type="range", severity="error", columns=["price"], min=0)]


def two_deliveries(spark: SparkSession, sf_dir: str, at_once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Silver products and their dimension. The second delivery lacks every 13th part, has a bad price for every 7th and a new one for every 5th.

    at_once: both snapshots wait in one batch.
    """
    root = shared_folder(spark, "deliveries")
    env = Environment(name="demo", warehouse=f"{root}/warehouse", landing_root=f"{root}/landing", checkpoint_root=f"{root}/checkpoints", schema_root=f"{root}/schemas", fail_threshold=0.5, buckets=8)
    entity = Entity(name="products", source=Source(system="pim", format="parquet", path_glob="products/dt=*/*.parquet"), load_type="full", primary_key=["product_id"], watermark="updated_at", order_by=["updated_at"], scd_type="scd2", tracked=["price"])
    k = F.col("p_partkey")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    first = parts.select(k.alias("product_id"), F.col("p_retailprice").alias("price"), F.lit("2024-01-01T00:00:00").alias("updated_at"), F.lit("2024-01-01").alias("dt"))
    price = F.when(k % 7 == 0, -F.col("p_retailprice")).when(k % 5 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))
    second = parts.where(k % 13 != 0).select(k.alias("product_id"), price.alias("price"), F.lit("2024-03-01T00:00:00").alias("updated_at"), F.lit("2024-03-01").alias("dt"))
    for batch, landed in (("first", first), ("second", second)):
        landed.write.mode("append").partitionBy("dt").parquet(f"{root}/landing/products")
        if at_once and batch == "first":
            continue
        ingest_entity(spark, env, entity, batch, "demo")
        runner.process_silver(spark, env, entity, RULES, Audit(spark, env), batch)
    lake = runner.Lake(spark, env)
    return lake.silver("products"), lake.gold("dim_products")


def full_load(spark: SparkSession, sf_dir: str, at_once: bool = False) -> DataFrame:
    return two_deliveries(spark, sf_dir, at_once)[0].select("product_id", "price", "is_deleted")


def scd2_valid_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_deliveries(spark, sf_dir)[1].select("product_id", "price", "is_current", "is_deleted")


def merged_orders(spark: SparkSession, state: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """A table of state, with source merged in its buckets."""
    table = Table(spark, f"{shared_folder(spark, 'merged')}/orders", key, buckets=16)
    table.overwrite(state)
    table.merge(source)
    return table.read()


def late_changes(spark: SparkSession, changes: DataFrame, late: DataFrame, key: list[str], tracked: list[str], changed_at: str, entity: str) -> DataFrame:
    """A written dimension of changes after late ones: only the buckets of their keys are read and written again."""
    table = Table(spark, f"{shared_folder(spark, 'dimension')}/{entity}", key, buckets=16)
    table.overwrite(scd2(changes, key, tracked, changed_at, entity))
    keys = late.select(*key).distinct()
    near = table.read(buckets=table.touched(keys)).join(keys, key, "left_semi")
    table.replace(keys, apply_scd2(near, late, key, tracked, changed_at, entity))
    return table.read()


def merge_counts(spark: SparkSession, state: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """What a merge into buckets counted while it wrote, beside the rows that are then there."""
    table = Table(spark, f"{shared_folder(spark, 'counted')}/orders", key, buckets=16)
    table.overwrite(state)
    counts = table.merge(source)
    return table.read().agg(F.count("*").alias("rows")).select(*[F.lit(v).cast("long").alias(k) for k, v in counts.items()], "rows")


def changed_orders(spark: SparkSession, state: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """The change feed of a merge: of the buckets that it wrote alone."""
    table = Table(spark, f"{shared_folder(spark, 'feed')}/orders", key, buckets=16)
    table.overwrite(state)
    table.merge(source)
    return table.changes(0)


def evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of three deliveries of orders as json lines: the second has longer keys and a column more, the third
    a column less; every 10th line of it has a total that is no number, every 11th isn't json."""
    root = shared_folder(spark, "evolved")
    env = Environment(name="demo", warehouse=f"{root}/warehouse", landing_root=f"{root}/landing", checkpoint_root=f"{root}/checkpoints", schema_root=f"{root}/schemas")
    entity = Entity(name="orders", source=Source(system="erp", format="json", path_glob="orders/dt=*/*.txt"), load_type="incremental", primary_key=["id"], watermark="id", order_by=["id"])
    k, total = F.col("o_orderkey"), F.col("o_custkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    odd = F.when(k % 10 == 0, F.concat(F.lit("about "), total.cast("string"))).otherwise(total.cast("string"))
    deliveries = {
        "2024-01-01": orders.where(k % 3 == 0).select(F.to_json(F.struct(k.alias("id"), total.alias("total")))),
        "2024-01-02": orders.where(k % 3 == 1).select(F.to_json(F.struct((k + 3_000_000_000).alias("id"), total.alias("total"), F.col("o_orderstatus").alias("status")))),
        "2024-01-03": orders.where(k % 3 == 2).select(F.when(k % 11 == 0, F.concat(F.lit("order "), k.cast("string"))).otherwise(F.to_json(F.struct(k.alias("id"), odd.alias("total"))))),
    }
    for date, lines in deliveries.items():
        lines.write.text(f"{root}/landing/orders/dt={date}")
        ingest_entity(spark, env, entity, date, "demo")
    return read_bronze(spark, env, entity)
