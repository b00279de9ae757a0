"""URL filter over a sorted digest array.

Rules are (verdict, host, path prefix). Each is a key `host` + path; the 64-bit xxhash digests of all
keys lie sorted in one file with the full keys and verdicts. The driver writes it to the shared folder once,
Spark hands each machine a copy, and all workers there map that one copy: no list is too long for it. A
URL's candidates (every suffix of its host at a dot, times every prefix of its path that has the length of
some rule's path) are probed with one vectorised binary search a batch; a digest that is found counts only
if the stored string is equal.

Edge cases: a null url or one without "://" has empty host and path and no rule; the default verdict is
"allow", since a URL that is not in the array isn't blocked. Repeated rules count once; of rules with
one key the first wins; of fitting rules the longest key wins, then the longer host. No rules: every page
gets the default. Repeated pages are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.common import Scratch, map_arrow, read

#: The rules of the registered query: (verdict, host, path).
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.S)
SCHEMA = "page_id long, host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path of a URL."""
    m = _URL.search(url or "")
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


class DigestArray:
    """Sorted 64-bit digests of keys over the bytes of one buffer, with the keys for confirmation and their values.

    The buffer holds the number of keys n, n digests in order, n + 1 places of records (all 64 bits), and
    the records: the key's length (64 bits), key, value, so that keys may hold any bytes.
    """

    HEAD = 8

    def __init__(self, buffer: np.ndarray, digest: Callable[[bytes], int] = xxhash.xxh64_intdigest):
        n = int(buffer[:8].view(np.int64)[0])
        self.digest, self.digests = digest, buffer[8 : 8 + 8 * n].view(np.uint64)
        self.places = buffer[8 + 8 * n : 16 + 16 * n].view(np.int64)
        self.records = buffer[16 + 16 * n :]

    @staticmethod
    def pack(entries: list[tuple[bytes, bytes]], digest: Callable[[bytes], int] = xxhash.xxh64_intdigest) -> bytes:
        """The buffer of (key, value) pairs with distinct keys."""
        digests = np.array([digest(k) for k, _ in entries], np.uint64)
        order = np.argsort(digests, kind="stable")
        records = [np.int64(len(entries[i][0])).tobytes() + entries[i][0] + entries[i][1] for i in order]
        places = np.cumsum([0, *map(len, records)]).astype(np.int64)
        return b"".join([np.int64(len(entries)).tobytes(), digests[order].tobytes(), places.tobytes(), *records])

    def find(self, probes: list[bytes]) -> list[bytes | None]:
        """The value of each probe that is a key."""
        out: list[bytes | None] = [None] * len(probes)
        if not probes or not len(self.digests):
            return out
        wanted = np.array([self.digest(p) for p in probes], dtype=np.uint64)
        at = np.searchsorted(self.digests, wanted)
        for i in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == wanted):
            j = at[i]
            while j < len(self.digests) and self.digests[j] == wanted[i]:  # equal digests: compare strings
                record = self.records[self.places[j] : self.places[j + 1]].tobytes()
                end = self.HEAD + int.from_bytes(record[: self.HEAD], sys.byteorder)
                if record[self.HEAD : end] == probes[i]:
                    out[i] = record[end:]
                    break
                j += 1
        return out


_MAPPED: dict[str, DigestArray] = {}


def mapped(name: str) -> DigestArray:
    """The array in a file that Spark has handed to this machine, mapped once a worker."""
    if name not in _MAPPED:
        _MAPPED[name] = DigestArray(np.memmap(SparkFiles.get(name), np.uint8, "r"))
    return _MAPPED[name]


def hand_out(spark: SparkSession, data: bytes) -> str:
    """Writes a file to the shared folder and has Spark copy it to each machine; its name."""
    sc, name = spark.sparkContext, f"{uuid.uuid4().hex}.digests"
    where = sc._jvm.org.apache.hadoop.fs.Path(f"{Scratch(spark, 'url-filter').base}/{name}")
    out = where.getFileSystem(sc._jsc.hadoopConfiguration()).create(where, True)
    try:
        for k in range(0, len(data), 1 << 24):
            out.write(bytearray(data[k : k + (1 << 24)]))
    finally:
        out.close()
    sc.addFile(where.toString())
    return name


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[tuple[str, str]]:
    """(host suffix, path prefix) pairs, longest key first, then longer host."""
    labels = host.split(".") if host else []
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    pairs = [(h, path[:n]) for h in hosts for n in lengths if n <= len(path)]
    return iter(sorted(pairs, key=lambda p: (-len(p[0]) - len(p[1]), -len(p[0]))))


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of `pages` (page_id, url)."""
    known: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        known.setdefault((host.translate(_UPPER), path), verdict)
    lengths = sorted({len(p) for _, p in known})
    name = hand_out(pages.sparkSession, DigestArray.pack([(f"{h}\0{p}".encode(), f"{v}\0{h}{p}".encode()) for (h, p), v in known.items()]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            probes, rows = [], []
            for i, (host, path) in enumerate(split):
                for h, p in candidates(host, path, lengths):
                    probes.append(f"{h}\0{p}".encode())
                    rows.append(i)
            best: dict[int, list[str]] = {}
            for i, found in zip(rows, mapped(name).find(probes)):
                if found is not None:
                    best.setdefault(i, found.decode().split("\0", 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id").cast(pa.int64()),
                    pa.array([h for h, _ in split], pa.string()),
                    pa.array([p for _, p in split], pa.string()),
                    pa.array([best[i][1] if i in best else None for i in range(len(split))], pa.string()),
                    pa.array([best[i][0] if i in best else default for i in range(len(split))], pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    return map_arrow(pages.select("page_id", "url"), judge, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages", "page_id", "url"), RULES)


_FITS = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), ruled AS (
  SELECT page_id, host, path, CASE {cases} END AS rule FROM split
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ({blocks}) THEN 'block' ELSE 'allow' END AS verdict FROM ruled
""".format(
    cases=" ".join(f"WHEN {_FITS.format(h=h, p=p)} THEN '{h}{p}'" for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))),
    blocks=", ".join(f"'{h}{p}'" for v, h, p in RULES if v == "block"),
)
