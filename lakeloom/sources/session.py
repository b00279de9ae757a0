"""The Spark session and its namespaces."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeloom.config import Environment

LAYERS = ("bronze", "silver", "gold", "audit")


def get_spark(app: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; a running one is reused."""
    builder = SparkSession.builder.appName(app)
    if master or not (os.environ.get("SPARK_MASTER") or on_managed_cluster()):
        builder = builder.master(master or "local[*]").config("spark.sql.shuffle.partitions", "8")
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def on_managed_cluster() -> bool:
    """Whether something else brought the session's settings: a launcher script, or a session that runs."""
    return bool(os.environ.get("SPARK_ENV_LOADED")) or SparkSession.getActiveSession() is not None


def ensure_namespaces(spark: SparkSession, env: Environment) -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{env.warehouse}/{layer}'")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def rows_to_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Driver rows under an explicit schema; keys that a row lacks are NULL."""
    names = T.StructType.fromDDL(schema).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
