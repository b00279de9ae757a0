"""Versioned Parquet tables: folders of rows and a manifest that names those of the current version.

A commit writes new folders, then its manifest under a temporary name, and gives that its number by a rename
that replaces nothing: a reader sees the old version or the new one, and of two writers one fails. Appends then
try again, a bounded number of times; other commits raise CommitConflict, as what they read has changed. Numbers
whose manifest is broken are stepped over. Threads of one process take turns. Versions stay until vacuum.

A table with buckets deals its rows by a hash of the key into partition folders. A merge reads and writes only
the buckets that its source touches; the next version names their new folders and the old ones of all others, so
its cost goes with the batch. Counts come from the write itself (observed metrics); no table is read again.
"""

from __future__ import annotations

import json
import random
import threading
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.clustering import clustered, dealt
from lakeloom.operators.merge import merge_marked, snapshot_diff

RETAIN_HOURS = 168
TARGET_BYTES = 256 << 20
#: Folders of a version beyond which an append puts them together.
MAX_FOLDERS = 64
#: Times that an append tries.
ATTEMPTS = 12
BUCKET = "_bucket"
_LOCKS: dict[str, threading.RLock] = {}


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the table."""


class Table:
    def __init__(self, spark: SparkSession, path: str, key: list[str] | None = None, partition_by: list[str] | None = None, cluster_by: list[str] | None = None, buckets: int = 0):
        self.spark, self.path = spark, path.rstrip("/")
        self.key, self.partition_by, self.cluster_by = key or [], partition_by or [], cluster_by or []
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._lock = _LOCKS.setdefault(self.path, threading.RLock())
        if not self.key and (m := self.manifest):
            self.key = m["key"]
        self._buckets = buckets if self.key else 0

    # -- the manifest

    @property
    def manifest(self) -> dict | None:
        for name in sorted(self._manifests(), reverse=True):
            text = self._text(name)
            if text.endswith("}\n"):  # else its writer died
                return json.loads(text)
        return None

    def _manifests(self) -> list[str]:
        where = self._path(f"{self.path}/_manifests")
        if not self._fs.exists(where):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(where)]
        return [n for n in names if n.endswith(".json") and not n.startswith(".")]

    def _text(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.path}/_manifests/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        number = 1 + max((int(n.removesuffix(".json")) for n in self._manifests()), default=-1)
        if manifest["commit"] < number - 1 and self._text(f"{number - 1:012d}.json").endswith("}\n"):
            raise CommitConflict(f"{self.path} has been committed to by another writer")
        draft = self._path(f"{self.path}/_manifests/.{uuid.uuid4().hex}.draft")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray((json.dumps(manifest | {"commit": number}) + "\n").encode()))
        finally:
            out.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        nothing = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(draft, self._path(f"{self.path}/_manifests/{number:012d}.json"), nothing)
        except Exception as e:
            self._fs.delete(draft, False)
            if "exist" in str(e):
                raise CommitConflict(f"{self.path} has been committed to by another writer") from e
            raise

    def exists(self) -> bool:
        return self.manifest is not None

    def version(self) -> int:
        m = self.manifest
        return m["version"] if m else -1

    def history(self) -> list[dict]:
        m = self.manifest
        return m["history"] if m else []

    def metrics(self) -> dict:
        """Of the last commit, and the table's notes."""
        m = self.manifest
        return m["history"][-1]["metrics"] | m["notes"] if m else {}

    @property
    def buckets(self) -> int:
        """As the table was made."""
        m = self.manifest
        return m["buckets"] if m else self._buckets

    # -- reading

    def _entry(self, version: int | None) -> dict:
        m = self.manifest
        if m is None:
            raise FileNotFoundError(f"no table at {self.path}")
        entry = m["history"][-1] if version is None else next((h for h in m["history"] if h["version"] == version), None)
        if entry is None:
            raise KeyError(f"version {version} isn't there")
        return entry

    def _frame(self, folders: list[str], schema: str) -> DataFrame:
        kind = T.StructType.fromJson(json.loads(schema))
        if not folders:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """A version's rows, of the given buckets alone if given."""
        entry = self._entry(version)
        folders = entry["folders"]
        if buckets is not None:
            folders = [f for f in folders if int(f.rpartition("=")[2]) in buckets]
        return self._frame(folders, entry["schema"])

    def changes(self, since: int, to: int | None = None) -> DataFrame:
        """Inserted, updated and deleted rows between two versions; folders that both have aren't read."""
        before, after = self._entry(since), self._entry(to)
        gone = [f for f in before["folders"] if f not in after["folders"]]
        new = [f for f in after["folders"] if f not in before["folders"]]
        return snapshot_diff(self._frame(gone, before["schema"]), self._frame(new, after["schema"]), self.key)

    # -- writing

    def bucket_of(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(n)).cast("int")

    def touched(self, rows: DataFrame) -> set[int]:
        """The buckets of a frame's keys: at most as many numbers as there are buckets."""
        return {r[0] for r in rows.select(self.bucket_of(self.buckets)).distinct().collect()}

    def _write(self, df: DataFrame, folder: str, **counts: Column) -> tuple[list[str], dict]:
        """Writes a folder; the paths that hold its rows, and what was counted on the way (columns named in counts go)."""
        seen, n = Observation(), self.buckets
        extra = [c for c in df.columns if c.startswith("_merge_")]
        if self.cluster_by:
            df = clustered(df, self.cluster_by)
        if n:
            # adaptive execution splits a large bucket and puts small ones together
            df = df.withColumn(BUCKET, self.bucket_of(n)).hint("rebalance", BUCKET)
        elif self.partition_by and not self.cluster_by:
            df = df.hint("rebalance", *self.partition_by)
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counts.items()]).drop(*extra)
        df.write.partitionBy(*[BUCKET] * bool(n), *self.partition_by).parquet(f"{self.path}/{folder}")
        got = {k: v or 0 for k, v in seen.get.items()}
        if not n:
            return [folder], got
        there = self._fs.listStatus(self._path(f"{self.path}/{folder}"))
        return sorted(f"{folder}/{f.getPath().getName()}" for f in there if f.isDirectory()), got

    def _commit(self, operation: str, folders: list[str], metrics: dict, based_on: int, schema: T.StructType | None = None, notes: dict | None = None) -> int:
        """The next version; based_on is the version that the writer has read."""
        with self._lock:
            m = self.manifest or {"version": -1, "commit": -1, "key": self.key, "buckets": self._buckets, "notes": {}, "history": []}
            if m["version"] != based_on:
                raise CommitConflict(f"{self.path} is at version {m['version']}, not {based_on}")
            version = based_on + 1
            kind = schema.json() if schema is not None else m["history"][-1]["schema"]
            entry = {"version": version, "operation": operation, "folders": folders, "at": time.time(), "metrics": metrics, "schema": kind}
            self._publish(m | {"version": version, "notes": m["notes"] | (notes or {}), "history": [*m["history"], entry]})
        return version

    def _folder(self) -> str:
        return f"v={self.version() + 1}-{uuid.uuid4().hex[:8]}"

    def _drop(self, folder: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{folder}"), True)

    def overwrite(self, df: DataFrame, **notes) -> int:
        """Replaces all rows; notes are kept with the table."""
        folder, based_on = self._folder(), self.version()
        folders, counts = self._write(df, folder)
        return self._commit("overwrite", folders, counts, based_on, df.schema, notes)

    def append(self, df: DataFrame) -> int:
        folders, counts = self._write(df, self._folder())
        for attempt in range(ATTEMPTS):
            try:
                with self._lock:
                    m = self.manifest
                    before = m["history"][-1] if m else {"folders": [], "schema": T.StructType().json()}
                    kinds = T.StructType.fromJson(json.loads(before["schema"]))
                    schema = T.StructType([*kinds.fields, *[f for f in df.schema.fields if f.name not in kinds.names]])
                    version = self._commit("append", [*before["folders"], *folders], counts, m["version"] if m else -1, schema)
                    if len(before["folders"]) >= MAX_FOLDERS and not self.buckets:
                        version = self.optimize()
                return version
            except CommitConflict:
                if attempt == ATTEMPTS - 1:
                    raise
                time.sleep(min(2.0, 0.02 * 2**attempt) * random.uniform(0.5, 1))
        raise AssertionError

    def merge(self, source: DataFrame, watermark: str | None = None, always: bool = False, **notes) -> dict:
        """Newer rows of the source replace and join the table's; the source must have one row a key.

        One join gives the rows and the counts. With buckets only those of the source's keys are read and written.
        """
        based_on, folder = self.version(), self._folder()
        source = source.withColumn("_merge_copies", F.count("*").over(Window.partitionBy(*self.key)))
        copies = F.max("_merge_copies")
        if based_on < 0:
            folders, counts = self._write(source, folder, copies=copies)
            counts |= {"inserted": counts["rows"], "updated": 0, "ignored": 0}
            kept, kinds = [], source.schema
        else:
            touched = self.touched(source) if self.buckets else None
            now = self.read(buckets=touched)
            rows = merge_marked(now, source, self.key, watermark, always)
            marks = {k: F.count_if(F.col("_merge_kind") == k) for k in ("inserted", "updated", "ignored")}
            folders, counts = self._write(rows, folder, copies=copies, **marks)
            kept = [f for f in self._entry(based_on)["folders"] if touched is not None and int(f.rpartition("=")[2]) not in touched]
            kinds = rows.schema
        if counts.pop("copies") > 1:
            self._drop(folder)
            raise ValueError("a merge's source has a key twice")
        kinds = T.StructType([f for f in kinds.fields if not f.name.startswith("_merge_")])
        self._commit("merge", [*kept, *folders], counts, based_on, kinds, notes)
        return {k: counts[k] for k in ("inserted", "updated", "ignored")}

    def replace(self, keys: DataFrame, rows: DataFrame, **notes) -> int:
        """All rows of the given keys go and `rows` come, in the buckets of either; a key may have many rows."""
        based_on, folder = self.version(), self._folder()
        touched = self.touched(keys.select(*self.key).unionByName(rows.select(*self.key))) if self.buckets else None
        now = self.read(buckets=touched)
        kept = [f for f in self._entry(based_on)["folders"] if touched is not None and int(f.rpartition("=")[2]) not in touched]
        out = dealt(now, self.key).join(keys.select(*self.key).distinct(), self.key, "left_anti").select(*now.columns).unionByName(rows, allowMissingColumns=True)
        folders, counts = self._write(out, folder)
        return self._commit("replace", [*kept, *folders], counts, based_on, out.schema, notes)

    # -- maintenance

    def optimize(self, files: int | None = None) -> int:
        """The current rows in fewer, larger files, clustered if the table is. Buckets are written whole anyway."""
        if self.buckets:
            return self.version()
        df, based_on = self.read(), self.version()
        if not self.cluster_by:
            total = sum(self._fs.getContentSummary(self._path(f"{self.path}/{f}")).getLength() for f in self.history()[-1]["folders"])
            df = df.repartition(files or max(1, int(total // TARGET_BYTES) + 1))
        folders, counts = self._write(df, self._folder())
        return self._commit("optimize", folders, counts, based_on, df.schema)

    def vacuum(self, retain_hours: float = RETAIN_HOURS, now: float | None = None, force: bool = False) -> list[str]:
        """Deletes folders that only versions older than the limit use, and those of that age that no version names
        (of writers that failed or lost); under 7 days needs force."""
        if retain_hours < RETAIN_HOURS and not force:
            raise ValueError(f"versions are kept for {RETAIN_HOURS} hours at least")
        m = self.manifest
        if m is None:
            return []
        limit = (now or time.time()) - retain_hours * 3600
        # a version is needed until it was replaced longer ago than the limit
        replaced = [h["at"] for h in m["history"][1:]] + [float("inf")]
        kept = [h for h, end in zip(m["history"], replaced) if end >= limit]
        used = {f for h in kept for f in h["folders"]}
        roots = {f.partition("/")[0] for f in used}
        gone = {f for h in m["history"] for f in h["folders"]} - used
        named = {f.partition("/")[0] for h in m["history"] for f in h["folders"]}
        for f in self._fs.listStatus(self._path(self.path)):
            name = f.getPath().getName()
            if name.startswith("v=") and name not in roots and (name in named or f.getModificationTime() / 1000 < limit):
                gone = {g for g in gone if g.partition("/")[0] != name} | {name}
        with self._lock:
            self._publish(m | {"history": kept})
        for name in sorted(self._manifests())[:-1]:
            self._fs.delete(self._path(f"{self.path}/_manifests/{name}"), False)
        for f in gone:
            self._drop(f)
        return sorted(gone)
