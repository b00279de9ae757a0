"""What the text operators share: reading, Arrow chunks, scratch tables in the shared folder."""

from __future__ import annotations

import atexit
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows a batch that goes to Python; texts may be long, so far fewer than Spark's 10,000.
ARROW_ROWS = 512
#: Bytes of text that a Python step handles at once. A single longer text makes a chunk of its own.
CHUNK_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """A table of the given directory, with only the named columns."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def any_order(df: DataFrame, *but: str) -> Column:
    """A number by which rows that differ have a fixed order, whatever task they come from."""
    names = [n for n, t in df.dtypes if n not in but and "map<" not in t and "variant" not in t]
    return F.xxhash64(*map(quoted, names))


def schema_of(df: DataFrame) -> str:
    return ", ".join(f"{quoted(n)} {t}" for n, t in df.dtypes)


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of batches whose `column` (string or binary) has at most `limit` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def gathered(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of narrow rows put together to about `rows` each; none is empty."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= rows:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with batches small enough for long texts; workers find this package where the driver does."""
    workers_path(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df.mapInArrow(function, schema)


def workers_path(spark: SparkSession) -> None:
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and where each row starts (one more offset than rows). Null: empty."""
    values = pc.fill_null(values, "")
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(values) else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Scratch:
    """Tables written to the folder that all executors share, read back as new plans.

    Writing cuts lineage: an executor lost later costs no recomputation before the last table. The
    folder is spark.checkpoint.dir; only on one machine (a local master) may that be unset, for a temporary one.
    No _SUCCESS file is made: nobody asks for it, and on a local disk the driver starts a process for each.
    Shuffle files of a finished write go at once, so disk holds one phase of an operator, not all. With
    shuffled=True, joins of the written plan are sort-merge joins at every size, but for those that ask
    for a broadcast: such a plan costs in proportion to its input.
    """

    def __init__(self, spark: SparkSession, name: str, shuffled: bool = False):
        self.spark, self.paths, self.shuffled = spark, {}, shuffled
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = _local_dir()
        self.base = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.clear)

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path, conf = f"{self.base}/{name}-{len(self.paths)}-{uuid.uuid4().hex[:8]}", self.spark.conf
        wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
        if self.shuffled:
            wanted |= {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
        before = {k: conf.get(k, None) for k in wanted}
        try:
            for k, v in wanted.items():
                conf.set(k, v)
            df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(*partition_by).parquet(path)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that no plan still needs, and lets Spark drop what only they held."""
        for name in names:
            self._delete(self.paths.pop(name))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def clear(self) -> None:
        try:
            self._delete(self.base)
        except Exception:  # the session has ended
            pass

    def _delete(self, path: str) -> None:
        sc = self.spark.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


_LOCAL: list[str] = []


def _local_dir() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="lakeloom-"))
    return f"file://{_LOCAL[0]}"
