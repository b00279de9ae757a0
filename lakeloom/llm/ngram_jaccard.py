"""N-gram Jaccard self-join of documents by a grouped prefix join, down to components.

A document is its set of hashed word n-grams (64 bits). Equal sets are one node; nodes are grouped by prefix
and size, group pairs filtered, members verified and joined by setjoin.

The order needs only to be the same everywhere: n-grams that some task sees at least twice are counted
over all tasks, the MAX_HEAVY most frequent get their counts, all others 0, ties go by hash. The counts
have a size bound (16 bytes each) and are the only thing that is broadcast.

Edge cases: a document with fewer words than n has one n-gram, its whole sequence; null and wordless
texts have an empty set and stay alone; rows that share a doc_id (or have none) are nodes by their texts; a
null doc_id is never a component's name unless nothing else is in it; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, any_order, chunks, fresh, map_arrow, mix64, quoted, read, text_bytes
from lakeloom.llm.setjoin import linked_components

MAX_HEAVY = 1_000_000
#: A task counts this many n-grams at once.
COUNTED = 4_000_000
#: Bytes of a word beyond which it is hashed by itself.
LONG_WORD = 256
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: ASCII letters alone.
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: Masks of the first 0 to 8 bytes of a word of memory, which are its lowest.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of UTF-8 texts that lie one after another, and how many each text has."""
    word = ~_BLANK[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    filled = np.flatnonzero(np.diff(offsets))  # words end where texts do
    first[offsets[filled]] = word[offsets[filled]]
    last[offsets[filled + 1] - 1] = word[offsets[filled + 1] - 1]
    starts = np.flatnonzero(first)
    lengths = np.flatnonzero(last) + 1 - starts
    padded = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 1,), (1,))  # the 8 bytes from each place on
    h = mix64(lengths.astype(np.uint64))
    at = np.flatnonzero(lengths <= LONG_WORD)
    for done in range(0, LONG_WORD, 8):
        at = at[lengths[at] > done]
        if not len(at):
            break
        h[at] = mix64(h[at] * np.uint64(0x9E3779B97F4A7C15) + (eight[starts[at] + done] & _FIRST[np.minimum(lengths[at] - done, 8)]))
    for i in np.flatnonzero(lengths > LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(padded[starts[i] : starts[i] + lengths[i]])
    return h, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(texts: list[str | None] | pa.Array, n: int) -> list[np.ndarray]:
    """For each text its distinct n-gram hashes, in order."""
    data, offsets = text_bytes(pa.array(texts, pa.string()) if isinstance(texts, list) else texts)
    flat, counts = _word_hashes(data, offsets)
    h = mix64(flat + np.uint64(n))
    for k in range(1, n):
        h = mix64(h[: len(flat) - k] * np.uint64(0x9E3779B97F4A7C15) + flat[k:]) if len(flat) > k else h[:0]
    out, at = [], 0
    for c in counts.tolist():
        if c >= n:
            own = np.sort(h[at : at + c - n + 1])
            new = own[1:] != own[:-1]
            out.append(own if new.all() else np.concatenate([own[:1], own[1:][new]]))
        elif c:
            out.append(mix64(np.array([xxhash.xxh3_64_intdigest(flat[at : at + c].tobytes(), seed=c)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def _long_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def heavy_counts(docs: DataFrame, n: int, most: int = MAX_HEAVY) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams and in how many documents they are, of those that repeat within a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            values = np.sort(np.concatenate(held))
            starts = np.flatnonzero(np.concatenate([[True] * bool(len(values)), values[1:] != values[:-1], [True]]))
            counts = np.diff(starts)
            keep = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(values[starts[:-1][keep]].view(np.int64)), pa.array(counts[keep].astype(np.int64))], ["s", "n"])

        for b in chunks(batches, "text"):
            own = shingle_sets(b.column("text"), n)
            held += own
            size += sum(map(len, own))
            if size > COUNTED:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counts = map_arrow(docs.select("text"), count, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where("n > 4")
    counts = counts.persist()
    try:
        levels = counts.groupBy(F.log2("n").cast("int").alias("level")).agg(F.count("*").alias("c")).collect()
        least, total = 64, 0
        for level, c in sorted(((r.level, r.c) for r in levels), reverse=True):
            if total + c > most:
                break
            least, total = level, total + c
        got = counts.where(F.log2("n").cast("int") >= least).toPandas()
    finally:
        counts.unpersist()
    s = got["s"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(s)
    return s[order], got["n"].to_numpy(np.int64)[order]


def prefixes(docs: DataFrame, n: int, num: int, den: int, heavy: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """doc_id, text_hash, k (the set's 128-bit key), n, weight (how frequent the prefix is), prefix of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts = sent.value
        for b in chunks(batches, "text"):
            keys, sizes, weights, cut = [], [], [], []
            for own in shingle_sets(b.column("text"), n):
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(len(own))
                p = len(own) - (-(-num * len(own) // den)) + 1 if len(own) else 0
                weight = 0
                if len(tokens) and len(own):
                    at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                    df = np.where(tokens[at] == own, counts[at], 0)
                    rare = own[df == 0]
                    if len(rare) >= p:
                        own = rare
                    else:
                        order = np.argsort(df, kind="stable")[:p]  # own is in order already
                        own, weight = own[order], int(df[order].sum())
                cut.append(own[:p])
                weights.append(weight)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("text_hash"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64()), _long_lists(cut)], ["doc_id", "text_hash", "k", "n", "weight", "prefix"])

    return map_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), run, "doc_id long, text_hash long, k binary, n long, weight long, prefix array<long>")


def whole_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(k, s): the n-grams of the nodes in `wanted` (k), made again from one text of each."""
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    ids = rows.join(wanted, "k", "left_semi").groupBy("k").agg(F.min(place).alias("r")).select(F.col("k").alias("wanted_k"), F.col("r.doc_id").alias("wanted_id"), F.col("r.text_hash").alias("wanted_hash"))
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    found = hashed.join(ids, (F.col("text_hash") == F.col("wanted_hash")) & F.col("doc_id").eqNullSafe(F.col("wanted_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            keys = b.column("wanted_k").to_pylist()
            # rows equal in doc_id and text: once a chunk
            at = list({k: i for i, k in enumerate(keys)}.values())
            own = shingle_sets(b.column("text").take(pa.array(at, pa.int64())), n)
            good = [i for i, (s, j) in enumerate(zip(own, at)) if xxhash.xxh3_128_digest(s.tobytes()) == keys[j]]
            yield pa.RecordBatch.from_arrays([pa.array([keys[at[i]] for i in good], pa.binary()), _long_lists([own[i] for i in good])], ["k", "s"])

    got = map_arrow(found.select("text", "wanted_k"), run, "k binary, s array<long>")
    return got.groupBy("k").agg(F.first("s").alias("s"))


def link(docs: DataFrame, n: int, num: int, den: int, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (its key, null for an empty set), component_id of every row."""
    scratch = scratch or Scratch(docs.sparkSession, "ngram-jaccard", shuffled=True)
    docs = docs.select("doc_id", "text")
    rows = scratch.save(prefixes(docs, n, num, den, heavy_counts(docs, n)), "rows")
    nodes = rows.where("n > 0").groupBy("k").agg(F.first("n").alias("n"), F.first("weight").alias("weight"), F.first("prefix").alias("prefix"))
    final = linked_components(nodes, lambda wanted: whole_sets(docs, rows, wanted, n), num, den, scratch)

    # rows without words share one empty set, and meet nobody
    worded = rows.where("n > 0").select("doc_id", "text_hash", "k", "n").join(final, "k", "left").select("doc_id", "text_hash", "n", F.coalesce("component", "k").alias("component"))
    worded = scratch.save(worded, "worded")
    names = worded.groupBy("component").agg(F.min("doc_id").alias("least"))
    got = worded.join(names, "component").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component", F.col("least").alias("component_id"))
    alone = rows.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.lit(None).cast("binary").alias("component"), F.col("doc_id").alias("component_id"))
    return got.unionByName(alone)


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows with one of each component left, that of its smallest doc_id; rows without words all stay.

    Of rows that share that doc_id the one with the smaller text hash stays, of rows equal in both the one
    first by a hash of its columns.
    """
    hash_, id_, found_, alone_, row_ = fresh(docs, "_text_hash", "_id", "_found_hash", "_alone", "_row")
    linked = link(docs, n, num, den)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    first = linked.where("n_shingles > 0").groupBy("component").agg(F.min(place).alias("p")).select("p.doc_id", "p.text_hash", F.lit(False).alias(alone_))
    empty = linked.where("n_shingles = 0").select("doc_id", "text_hash", F.lit(True).alias(alone_)).distinct()
    chosen = first.unionByName(empty).select(F.col("doc_id").alias(id_), F.col("text_hash").alias(found_), alone_)
    got = docs.withColumn(hash_, F.xxhash64("text")).join(chosen.hint("merge"), F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(hash_) == F.col(found_)))
    columns = [F.col(quoted(c)) for c in docs.columns]
    # rows that are equal in doc_id and text are in one component
    one = got.where(~F.col(alone_)).groupBy("doc_id", hash_).agg(F.min_by(F.struct(*columns), any_order(docs)).alias(row_)).select(f"{row_}.*")
    return one.unionByName(got.where(alone_).select(*columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "documents", "doc_id", "text"), 4, 85, 100).select("doc_id", "n_shingles", "component_id")


def brute_force(rows: list[tuple[int, str | None]], n: int = 4, num: int = 85, den: int = 100) -> dict[int, tuple[int, int]]:
    """The query's result in plain Python, for tests: doc_id to set size and component."""
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}


SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 4 THEN array_to_string(w[i:i + 3], ' ') ELSE array_to_string(w, ' ') END AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, least(len(w), 1)))) AS i FROM worded)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
