"""Line deduplication by overlapping three-line windows.

Every three consecutive lines of a document make a window, known by the 128-bit hash of its text. A
window that occurs before (smaller doc_id, or earlier in the document) is a repeat, and every line that
some repeat covers goes; windows are judged on the input, not on what is left.

Window hashes are pre-aggregated to their first occurrence, so a window that a third of all documents
share is one row a task; only the join that marks later occurrences meets it again, and that join can be
split.

Edge cases: documents of under three lines have no window and stay; null text: no lines; null doc_id
comes first; rows that share a doc_id but not the text are documents in order of their text's hash;
rows equal in both are one document, seen twice, and get the same result; windows of empty lines are windows
like others; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, chunks, fresh, map_arrow, quoted, read, schema_of

WINDOW = 3


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, pos, h1, h2 of every window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            row, pos, digests = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                lines = (text or "").split("\n")
                for k in range(len(lines) - size + 1):
                    row.append(i)
                    pos.append(k)
                    digests.append(xxhash.xxh3_128_digest("\n".join(lines[k : k + size]).encode()))
            h = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()).take(at), b.column("text_hash").take(at), pa.array(pos, pa.int32()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], ["doc_id", "text_hash", "pos", "h1", "h2"])

    return map_arrow(docs.select("doc_id", "text", "text_hash"), run, "doc_id long, text_hash long, pos int, h1 long, h2 long")


def repeats(docs: DataFrame, scratch: Scratch, size: int = WINDOW) -> DataFrame:
    """doc_id, text_hash, and the places of all windows that occurred before, for documents with any."""
    place = F.struct("doc_id", "text_hash", "pos")
    found = windows(docs, size)
    firsts = found.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    firsts = scratch.save(firsts, "firsts")
    later = found.join(firsts, ["h1", "h2"]).where(place > F.col("first"))
    return scratch.save(later.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("places")), "repeats")


def kept_lines(text: str | None, places: list[int] | None, size: int = WINDOW) -> tuple[list[str], int]:
    """The lines that no repeat covers, and the number of all lines."""
    lines = text.split("\n") if text is not None else []
    if not places:
        return lines, len(lines)
    covered = np.zeros(len(lines), bool)
    for p in places:
        covered[p : p + size] = True
    return [x for x, c in zip(lines, covered.tolist()) if not c], len(lines)


def dedup_lines(docs: DataFrame, size: int = WINDOW, scratch: Scratch | None = None) -> tuple[DataFrame, str, str]:
    """The rows with their text cut and two columns more, and the names of those: lines, removed lines."""
    scratch = scratch or Scratch(docs.sparkSession, "line-dedup", shuffled=True)
    hash_, id_, found_hash, places_, n_lines, n_removed = fresh(docs, "_text_hash", "_id", "_found_hash", "_places", "_n_lines", "_n_removed")
    hashed = docs.withColumn(hash_, F.xxhash64("text"))
    found = repeats(hashed.select("doc_id", "text", F.col(hash_).alias("text_hash")), scratch, size)
    found = found.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(found_hash), F.col("places").alias(places_))
    joined = hashed.join(found.hint("merge"), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(found_hash)), "left")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            texts, places = b.column("text").to_pylist(), b.column(places_).to_pylist()
            got = [kept_lines(t, p, size) for t, p in zip(texts, places)]
            new = pa.array([t if not p else "\n".join(k) for (k, _), t, p in zip(got, texts, places)], pa.string())
            counts = [pa.array([n for _, n in got], pa.int64()), pa.array([n - len(k) for k, n in got], pa.int64())]
            yield pa.RecordBatch.from_arrays([new if c == "text" else b.column(c) for c in columns] + counts, [*columns, n_lines, n_removed])

    out = map_arrow(joined.select(*map(quoted, columns), places_), run, f"{schema_of(docs)}, {n_lines} long, {n_removed} long")
    return out, n_lines, n_removed


def clean(docs: DataFrame) -> DataFrame:
    """The rows with their repeated lines gone, n_chars following; rows of which only blanks are left go."""
    got, _, removed = dedup_lines(docs)
    got = got.where((F.col(removed) == 0) | F.col("text").rlike(r"\S")).select(*map(quoted, docs.columns))
    return got.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else got


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, lines, removed = dedup_lines(read(spark, sf_dir, "documents", "doc_id", "text"))
    return got.select("doc_id", F.col(lines).alias("n_lines"), F.col(removed).alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int, str | None]], size: int = WINDOW) -> dict[int, tuple[int, int, str]]:
    """The query's result in plain Python, for tests."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        lines = text.split("\n") if text is not None else []
        gone = set()
        for k in range(len(lines) - size + 1):
            w = tuple(lines[k : k + size])
            if w in seen:
                gone |= set(range(k, k + size))
            seen.add(w)
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone)
        out[doc] = (len(lines), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


SQL = """
WITH lined AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(generate_series(1, len(lines))) AS i, lines FROM lined
), found AS (
  SELECT doc_id, i, concat(lines[i], chr(10), lines[i + 1], chr(10), lines[i + 2]) AS w FROM numbered WHERE i + 2 <= len(lines)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM found
  ) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM later, (SELECT unnest([0, 1, 2]) AS k)
), kept AS (
  SELECT n.doc_id, string_agg(n.lines[n.i], chr(10) ORDER BY n.i) FILTER (WHERE g.i IS NULL) AS kept, count(*) AS n_lines, count(g.i) AS n_removed
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.i = g.i GROUP BY n.doc_id
)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
