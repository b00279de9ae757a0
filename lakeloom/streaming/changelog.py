"""Change events from a log into the landing zone: verbatim, each epoch once, gaps reported.

An epoch (a micro-batch) lands as files named after it, `<table>/dt=<day>/part-<source>-<epoch>-<n>.parquet`, so
one that is replayed writes the same names again; it counts as landed when its marker is there, and a marker is
written after its files. Events stay as they came, with both images, so versions and deletions can be told later.
Offsets belong to the stream's checkpoint, which moves on after the marker.

Sequence numbers of a source are one more each event. An epoch that doesn't go on where the last one ended, or
holds fewer than its span, is reported with how many are missing; it lands all the same.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class ChangeLogSink:
    """foreachBatch(ChangeLogSink(spark, root, source).write)"""

    def __init__(self, spark: SparkSession, root: str, source: str, table: str = "source.table", sequence: str = "source.lsn", at: str = "ts_ms"):
        if not re.fullmatch(r"[\w-]+", source):
            raise ValueError("a source's name has letters, digits, _ and - alone")
        self.spark, self.root, self.source = spark, root.rstrip("/"), source
        self.table, self.sequence, self.at = table, sequence, at
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, batch: DataFrame, epoch: int) -> bool:
        """Lands an epoch; False if it had landed."""
        marker = f"{self.root}/_epochs/{self.source}/{epoch:012d}.json"
        if self._read(marker):
            return False
        draft = f"{self.root}/_drafts/{self.source}-{epoch:012d}"
        day = F.to_date(F.timestamp_millis(F.col(self.at)))
        events = batch.withColumns({"_table": F.col(self.table), "dt": day})
        events.write.mode("overwrite").partitionBy("_table", "dt").parquet(draft)
        self._land(draft, epoch)
        before = self._last(epoch)
        # each number once; those that came late, of a span told before, are no gap of this one
        numbers = batch.select(F.col(self.sequence).alias("n")).where("n is not null").distinct()
        new = F.count_if(F.col("n") > before) if before is not None else F.count(F.lit(1))
        seen = numbers.agg(F.min("n").alias("first"), F.max("n").alias("last"), F.count(F.lit(1)).alias("came"), new.alias("new")).first().asDict()
        missing = 0
        if seen["new"]:
            missing = seen["last"] - (seen["first"] - 1 if before is None else before) - seen["new"]
        self._write(marker, {"source": self.source, "epoch": epoch, **seen, "missing": missing, "last_before": before})
        self._fs.delete(self._path(draft), True)
        return True

    def _land(self, draft: str, epoch: int) -> None:
        """Files of the draft get their names; the number of files is that of the epoch's tables, days and tasks."""
        for table in self._fs.listStatus(self._path(draft)):
            if not table.isDirectory() or not table.getPath().getName().startswith("_table="):
                continue
            name = table.getPath().getName().removeprefix("_table=")
            for day in self._fs.listStatus(table.getPath()):
                folder = self._path(f"{self.root}/{name}/{day.getPath().getName()}")
                self._fs.mkdirs(folder)
                head = f"part-{self.source}-{epoch:012d}-"
                for old in self._fs.listStatus(folder):  # of an attempt that died
                    if old.getPath().getName().startswith(head):
                        self._fs.delete(old.getPath(), False)
                files = sorted(f.getPath().toString() for f in self._fs.listStatus(day.getPath()) if f.getPath().getName().startswith("part-"))
                for n, f in enumerate(files):
                    self._fs.rename(self._path(f), self._path(f"{folder.toString()}/{head}{n}.parquet"))

    def _last(self, epoch: int) -> int | None:
        """The largest number of the epochs before."""
        found = [e["last"] for e in self.epochs() if e["epoch"] < epoch and e["last"] is not None]
        return max(found, default=None)

    def epochs(self) -> list[dict]:
        folder = self._path(f"{self.root}/_epochs/{self.source}")
        if not self._fs.exists(folder):
            return []
        names = sorted(f.getPath().getName() for f in self._fs.listStatus(folder))
        found = [self._read(f"{self.root}/_epochs/{self.source}/{n}") for n in names if n.endswith(".json") and not n.startswith(".")]
        return [e for e in found if e]

    def gaps(self) -> list[dict]:
        """Epochs whose numbers aren't all there: source, epoch, last_before, first, last, came, missing."""
        return [e for e in self.epochs() if e["missing"]]

    def _read(self, path: str) -> dict | None:
        where = self._path(path)
        if not self._fs.exists(where):
            return None
        stream = self._fs.open(where)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return json.loads(text) if text.endswith("}\n") else None

    def _write(self, path: str, value: dict) -> None:
        out = self._fs.create(self._path(path), True)
        out.write(bytearray((json.dumps(value) + "\n").encode()))
        out.close()


def capture(stream: DataFrame, sink: ChangeLogSink, checkpoint: str) -> None:
    """What a stream of change events holds now, through the sink."""
    query = stream.writeStream.foreachBatch(lambda batch, epoch: sink.write(batch, epoch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
