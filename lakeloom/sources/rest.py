"""A paged REST source as a Python data source, batch and stream: bearer token, page size up to 500, updated_since, retries.

The server orders rows by (updated_at, key), returns those after `updated_since`, and pages them by number. Rows
that change meanwhile move to the end, so page numbers shift under a reader; readers here go forward by
updated_at instead, and by page number only within rows of one instant. A stream's offset is an updated_at, so
a span of offsets names the same rows whenever it is read, but for those that have changed since: they come
again, as they are now, in a later span. Spans are split among tasks; no rows pass the driver.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

MAX_PAGE_SIZE = 500
#: Tasks that a span is split among.
PARTITIONS = 4


def fetch(url: str, token: str, tries: int = 4, wait: float = 0.5, get: Callable[[str, str], tuple[int, bytes]] | None = None) -> dict:
    """One page as JSON; server errors are tried again with growing waits."""
    get = get or _get
    for n in range(tries):
        status, body = get(url, token)
        if status < 500:
            if status >= 400:
                raise RuntimeError(f"{url}: status {status}")
            return json.loads(body)
        time.sleep(wait * 2**n)
    raise RuntimeError(f"{url}: server errors on {tries} tries")


def _get(url: str, token: str) -> tuple[int, bytes]:
    request = urllib.request.Request(url, headers={"Authorization": f"Bearer {token}"})
    try:
        with urllib.request.urlopen(request, timeout=30) as r:
            return r.status, r.read()
    except urllib.error.HTTPError as e:
        return e.code, e.read()


def page_url(base: str, page: int, size: int, updated_since: str | None) -> str:
    if not 1 <= size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be 1 to {MAX_PAGE_SIZE}")
    query = {"page": page, "page_size": size} | ({"updated_since": updated_since} if updated_since else {})
    return f"{base}?{urllib.parse.urlencode(query)}"


def register(spark: SparkSession) -> None:
    """Makes format("rest_pages") known to the session."""
    spark.dataSource.register(RestSource)


class RestSource(DataSource):
    """spark.read or readStream, .format("rest_pages").schema(...).option("url", ...).option("token", ...).load()

    Options: url, token, page_size, updated_since (where to begin), partitions, tries, wait (seconds).
    """

    @classmethod
    def name(cls) -> str:
        return "rest_pages"

    def schema(self) -> str:
        raise ValueError("give a schema: pages are read by it")

    def reader(self, schema) -> DataSourceReader:
        return RestReader(schema, dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RestStreamReader(schema, dict(self.options))


class Span(InputPartition):
    """Rows with start < updated_at <= end; None: no limit."""

    def __init__(self, start: str | None, end: str | None):
        self.start, self.end = start, end


class Client:
    def __init__(self, schema, options: dict):
        self.schema, self.options = schema, {k.lower(): v for k, v in options.items()}
        self.size = int(self.options.get("page_size", MAX_PAGE_SIZE))

    def page(self, number: int, size: int, since: str | None) -> tuple[list[dict], int]:
        """A page's rows, and how many there are in all."""
        got = fetch(page_url(self.options["url"], number, size, since), self.options.get("token", ""), int(self.options.get("tries", 4)), float(self.options.get("wait", 0.5)))
        return got["data"], got["pagination"]["total"]

    def instant(self, number: int, since: str | None) -> str | None:
        """When the row of that number after `since` was updated."""
        rows, _ = self.page(number, 1, since)
        return rows[0]["updated_at"] if rows else None

    def latest(self, since: str | None) -> str | None:
        _, total = self.page(1, 1, since)
        return self.instant(total, since) if total else None

    def spans(self, start: str | None, end: str | None) -> list[Span]:
        """(start, end] in about equal parts, cut at instants of rows."""
        _, total = self.page(1, 1, start)
        n = max(1, min(int(self.options.get("partitions", PARTITIONS)), total // self.size))
        cuts = {self.instant(total * i // n, start) for i in range(1, n)} - {None}
        inner = sorted(c for c in cuts if end is None or c < end)
        edges = [start, *inner, end]
        return [Span(a, b) for a, b in zip(edges, edges[1:]) if a != b or a is None]

    def rows(self, span: Span) -> Iterator[tuple]:
        since = span.start
        while True:
            rows, _ = self.page(1, self.size, since)
            full, last = len(rows) == self.size, rows[-1]["updated_at"] if rows else None
            if full and rows[0]["updated_at"] == last:
                # all of one instant: whatever changes leaves it, so the rest of it is on the pages behind
                number, more = 1, rows
                while len(more) == self.size and more[-1]["updated_at"] == last:
                    number += 1
                    more, _ = self.page(number, self.size, since)
                    rows += more
                rows = list({json.dumps(r, sort_keys=True): r for r in rows if r["updated_at"] == last}.values())
            elif full:
                rows = [r for r in rows if r["updated_at"] != last]  # an instant that may go on: read next
            for row in rows:
                if span.end is not None and row["updated_at"] > span.end:
                    return
                yield self.typed(row)
            if not full or (span.end is not None and rows[-1]["updated_at"] >= span.end):
                return
            since = rows[-1]["updated_at"]

    def typed(self, row: dict) -> tuple:
        return tuple(None if row.get(f.name) is None else (row[f.name] if isinstance(row[f.name], str) else json.dumps(row[f.name])) if f.dataType.typeName() == "string" else row[f.name] for f in self.schema.fields)


class RestReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.client = Client(schema, options)

    def partitions(self) -> list[InputPartition]:
        start = self.client.options.get("updated_since")
        end = self.client.latest(start)
        return self.client.spans(start, end) if end else [Span(start, start)]

    def read(self, partition: Span) -> Iterator[tuple]:
        return iter(()) if partition.start is not None and partition.start == partition.end else self.client.rows(partition)


class RestStreamReader(DataSourceStreamReader):
    def __init__(self, schema, options: dict):
        self.client = Client(schema, options)
        self.at: str | None = None

    def initialOffset(self) -> dict:
        return {"updated_since": self.client.options.get("updated_since")}

    def latestOffset(self) -> dict:
        self.at = self.client.latest(self.at or self.client.options.get("updated_since")) or self.at or self.client.options.get("updated_since")
        return {"updated_since": self.at}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.client.spans(start["updated_since"], end["updated_since"])

    def read(self, partition: Span) -> Iterator[tuple]:
        return self.client.rows(partition)

    def commit(self, end: dict) -> None:
        pass
