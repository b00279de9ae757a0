"""Incremental ingestion of events, run twice, as a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.config import Entity, Environment, Source
from lakeloom.sources.staging import shared_folder
from lakeloom.streaming.ingest import bronze_path, ingest_entity


def two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "ingest")
    env = Environment(name="demo", warehouse=f"{root}/warehouse", landing_root=f"{root}/landing", checkpoint_root=f"{root}/checkpoints", schema_root=f"{root}/schemas")
    entity = Entity(name="events", source=Source(system="clickstream", format="parquet", path_glob="events/dt=*/*.parquet"), load_type="incremental", primary_key=["event_id"], watermark="ts", order_by=["ts"])
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    parts = {"first": events.where("dt < '2024-01-16'"), "second": events.where("dt >= '2024-01-16'")}
    for batch, landed in parts.items():
        landed.repartition("dt").write.mode("append").partitionBy("dt").parquet(f"{root}/landing/events")
        ingest_entity(spark, env, entity, batch, "demo")
    return spark.read.parquet(bronze_path(env, entity)).groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("events"), F.countDistinct("_file_name").alias("files"))
