"""Bronze: what has landed since the last run, once, with its provenance."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from lakeloom.config import Entity, Environment
from lakeloom.functions.keys import record_hash
from lakeloom.sources.files import FILE, FOLDER_COLUMNS, RESCUED, read_stream

BATCH_FOLDER = "_batch"
#: Name of the counts that a stream reports.
METRICS = "bronze"
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def add_ingest_metadata(df: DataFrame, system: str, batch_id: str, run_id: str) -> DataFrame:
    """Adds provenance; the hash covers source columns alone, without folder columns."""
    own = sorted(c for c in df.columns if not c.startswith("_") and c not in FOLDER_COLUMNS)
    out = df if FILE in df.columns else df.withColumn(FILE, F.lit(None).cast("string"))
    return out.withColumns(
        {
            "_ingest_ts": F.current_timestamp(),
            "_ingest_date": F.current_date(),
            "_source_system": F.lit(system),
            "_batch_id": F.lit(batch_id),
            "_run_id": F.lit(run_id),
            "_record_hash": record_hash([F.to_json(F.struct(F.col(c))) if "struct" in t or "map" in t or "array" in t else F.col(c) for c, t in df.dtypes if c in own]),
        }
    )


class Progress(StreamingQueryListener):
    """What queries have counted over all their micro-batches: rows, rows that didn't parse, micro-batches."""

    def __init__(self):
        self.totals: dict[str, dict] = {}
        self.ended: dict[str, threading.Event] = {}
        self.writing, self.open_before = 0, None

    @contextmanager
    def files_open(self, spark: SparkSession) -> Iterator[None]:
        """While any stream of the session writes, tasks keep a file open; sinks read the setting when they write."""
        with _REGISTER:
            if not self.writing:
                self.open_before = spark.conf.get(OPEN_FILES, None)
                spark.conf.set(OPEN_FILES, "1")
            self.writing += 1
        try:
            yield
        finally:
            with _REGISTER:
                self.writing -= 1
                if not self.writing:
                    spark.conf.unset(OPEN_FILES) if self.open_before is None else spark.conf.set(OPEN_FILES, self.open_before)

    def expect(self, run: str) -> None:
        self.totals.setdefault(run, {"rows": 0, "rescued": 0, "micro_batches": 0})
        self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self.expect(str(event.runId))

    def onQueryProgress(self, event) -> None:
        run, seen = str(event.progress.runId), event.progress.observedMetrics
        self.expect(run)
        if METRICS in seen:
            row = seen[METRICS].asDict()
            self.totals[run]["micro_batches"] += 1
            for k in ("rows", "rescued"):
                self.totals[run][k] += row[k] or 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.expect(str(event.runId))
        self.ended[str(event.runId)].set()

    def of(self, run: str, wait: float = 60) -> dict:
        """A finished query's totals; events come a little after its end."""
        self.expect(run)
        if not self.ended[run].wait(wait):
            raise TimeoutError("the query's progress didn't come")
        self.ended.pop(run)
        return self.totals.pop(run)


_LISTENERS: dict[tuple, Progress] = {}
_REGISTER = threading.Lock()


def progress_of(spark: SparkSession) -> Progress:
    """The session's listener; the first caller adds it."""
    with _REGISTER:
        session = (spark.sparkContext.applicationId, id(spark))
        if session not in _LISTENERS:
            _LISTENERS.clear()  # of sessions that have ended
            _LISTENERS[session] = Progress()
            spark.streams.addListener(_LISTENERS[session])
        return _LISTENERS[session]


def write_bronze(df: DataFrame, target: str, checkpoint: str) -> dict:
    """Runs the stream over what is there now; its counts come from the pass that writes.

    A folder for each batch, so that a batch is read alone. A run has one batch, so a task keeps one file open
    and needn't sort its rows by folder.
    """
    progress = progress_of(df.sparkSession)
    bad = F.count_if(F.col(RESCUED).isNotNull()) if RESCUED in df.columns else F.sum(F.lit(0))
    folder = df.withColumn(BATCH_FOLDER, F.concat(F.lit("b-"), F.col("_batch_id"))).observe(METRICS, F.count(F.lit(1)).alias("rows"), bad.alias("rescued"))
    with progress.files_open(df.sparkSession):
        query = folder.writeStream.format("parquet").partitionBy(BATCH_FOLDER).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
        query.awaitTermination()
    return progress.of(str(query.runId))


def read_bronze(spark: SparkSession, env: Environment, entity: Entity, batches: list[str] | None = None) -> DataFrame:
    """Bronze rows, of the named batches alone if given: no file of others is opened, not even for its schema.

    Which files count is told by the stream's own log, so what a failed run left isn't read.
    """
    path = bronze_path(env, entity)
    if batches is None:
        return spark.read.option("mergeSchema", "true").parquet(path).drop(BATCH_FOLDER)
    folders = batch_folders(spark, env, entity)
    if not batches:
        return spark.read.parquet(path).drop(BATCH_FOLDER).limit(0)
    kinds = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*[folders[b] for b in batches]).schema
    df = spark.read.schema(kinds).parquet(path)
    return df.where(F.col(BATCH_FOLDER).isin([f"b-{b}" for b in batches])).drop(BATCH_FOLDER)


def batch_folders(spark: SparkSession, env: Environment, entity: Entity) -> dict[str, str]:
    """Batch ids and their folders, by listing alone."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(bronze_path(env, entity))
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return {}
    found = {f.getPath().getName(): f.getPath().toString() for f in fs.listStatus(where) if f.isDirectory()}
    head = f"{BATCH_FOLDER}=b-"
    return {unquote(n.removeprefix(head)): p for n, p in found.items() if n.startswith(head)}


def bronze_batches(spark: SparkSession, env: Environment, entity: Entity, but: list[str] | tuple[str, ...] = ()) -> list[str]:
    """Batch ids in the order they came, without those named; only the batches that are left are read."""
    there = sorted(set(batch_folders(spark, env, entity)) - set(but))
    if len(there) < 2:
        return there
    rows = read_bronze(spark, env, entity, there).groupBy("_batch_id").agg(F.min("_ingest_ts").alias("at")).orderBy("at", "_batch_id").collect()
    return [r["_batch_id"] for r in rows]


def bronze_path(env: Environment, entity: Entity) -> str:
    return env.table_path("bronze", f"{entity.source.system}_{entity.name}")


def ingest_entity(spark: SparkSession, env: Environment, entity: Entity, batch_id: str, run_id: str) -> dict:
    """One entity's new files into Bronze, and what the pass that wrote them counted."""
    stream = add_ingest_metadata(read_stream(spark, env, entity), entity.source.system, batch_id, run_id)
    return write_bronze(stream, bronze_path(env, entity), env.checkpoint_path(entity.name))


def validate_bronze(batch: DataFrame) -> dict:
    """Rows, files, distinct records, and rows that didn't parse."""
    bad = F.count_if(F.col(RESCUED).isNotNull()) if RESCUED in batch.columns else F.lit(0).cast("long")
    one = batch.agg(F.count("*").alias("rows"), F.countDistinct("_file_name").alias("files"), F.countDistinct("_record_hash").alias("distinct_records"), bad.alias("rescued"))
    return one.first().asDict()
