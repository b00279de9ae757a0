"""Phrase collocations: which phrases of two and three words come together more often than their parts explain.

Texts are cut into pieces at punctuation and line ends, pieces into words; phrases stay within pieces.

1. Identical pieces become one piece with a multiplicity, per task first and then over all tasks, so a line
   that a third of all documents share is read once from there on.
2. Pieces give their n-grams, added up within a chunk of pieces and dealt to hash buckets as packed Arrow
   blobs: a phrase is one row a chunk at most, however frequent. Lengths are made one after another. Each bucket is counted by DuckDB within
   DUCK_MB of memory; what is more goes to a private folder of the task, deleted when the bucket is done
   (a lost executor's buckets are counted again elsewhere; nobody else reads that folder).
   Phrases and parts under `least` occurrences go there: a part is at least as frequent as the phrase.
3. Candidates ask for the counts of their parts: a row for each cut and side, shuffled to where the part's
   count is, and brought together again by phrase. Longer candidates tell their parts likewise.
4. Scores are exact integers (decimals of 38 digits); each language keeps its best rows, cut in each task
   before they meet.

The number of buckets grows with the pieces' bytes, so a bucket's size stays the same.

Edge cases: null text: empty; null lang is `und`, like a lang named so; empty pieces and texts of blanks have no
words; a piece of a very long text is one chunk; rows that share a doc_id (or have none) and repeated rows all
count; ties in score and count go by the phrase's UTF-8 bytes; an empty table gives no rows; other columns aren't
read.
"""

from __future__ import annotations

import tempfile
from collections import Counter
from collections.abc import Iterable, Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import CHUNK_BYTES, Scratch, chunks, map_arrow, mix64, read, text_bytes

LEAST = 10
KEPT = 2000
#: Memory of a bucket's counting, MB; what is more is spilled.
DUCK_MB = 128
#: Bytes of pieces a bucket.
BUCKET_BYTES = 4 << 20
#: Bytes of blobs that go to Python at once; a larger blob goes alone.
BATCH_BYTES = 4 << 20
#: Words of the longest phrase.
LONGEST = 3
#: Lower-case letters, piece ends as line ends, tabs as blanks: one byte each, so UTF-8 stays whole.
_TABLE = bytes(ord("\n") if chr(i) in ".,;:!?\n\x0b\x0c\r" else ord(" ") if i == 9 else i + 32 if 65 <= i <= 90 else i for i in range(256))
_BLOB = pa.schema([("lang", pa.string()), ("g", pa.string()), ("c", pa.int64())])


def pieces(docs: DataFrame) -> DataFrame:
    """lang, piece, c: the distinct pieces and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            data, offsets = text_bytes(b.column("text"))
            flat = pa.py_buffer(data.tobytes().translate(_TABLE))
            texts = pa.Array.from_buffers(pa.large_string(), b.num_rows, [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), flat])
            split = pc.split_pattern(texts, "\n")
            piece = pc.ascii_trim(split.flatten(), " ")
            lang = pc.fill_null(b.column("lang"), "und").take(pc.list_parent_indices(split))
            got = pa.table({"lang": lang, "piece": piece}).filter(pc.not_equal(piece, ""))
            got = got.group_by(["lang", "piece"], use_threads=False).aggregate([([], "count_all")])
            got = pa.table({"lang": got["lang"], "piece": got["piece"].cast(pa.string()), "c": got["count_all"]})
            yield from got.to_batches()

    one = map_arrow(docs.select("lang", "text"), run, "lang string, piece string, c long")
    return one.groupBy("lang", "piece").agg(F.sum("c").alias("c"))


def _by_bytes(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.nbytes
        if n >= limit:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def ngrams(batch: pa.RecordBatch, longest: int = LONGEST) -> Iterator[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]]:
    """By length, language, n-gram, count and hash of the n-grams of a batch of pieces, each once; first "", which counts all words."""
    split = pc.split_pattern(batch.column("piece"), " ")
    parent, flat = pc.list_parent_indices(split).to_numpy(), split.flatten()
    real = pc.not_equal(flat, "")
    flat, parent = flat.filter(real), parent[real.to_numpy(zero_copy_only=False)]
    coded, langs = flat.dictionary_encode(), batch.column("lang").dictionary_encode()
    words, names = coded.dictionary, langs.dictionary
    ids, v = coded.indices.to_numpy().astype(np.int64), max(1, len(words))
    lang, count = langs.indices.to_numpy().astype(np.int64)[parent], batch.column("c").to_numpy()[parent]
    word_hash = np.array([xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], np.uint64)
    name_hash = np.array([xxhash.xxh3_64_intdigest(w) for w in names.cast(pa.binary()).to_pylist()], np.uint64)

    def added(key: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first place of each key, and the sum of its counts."""
        code, _ = pd.factorize(key)
        first = np.full(code.max() + 1 if len(code) else 0, len(code), np.int64)
        np.minimum.at(first, code, np.arange(len(code)))
        total = np.zeros(len(first), np.int64)
        np.add.at(total, code, c)
        return first, total

    first, total = added(lang, count)
    yield names.take(pa.array(lang[first])), pa.array([""] * len(first), pa.string()), total, mix64(name_hash[lang[first]])
    # the code of the n-gram that starts at each word, and where there is one
    start, code = np.arange(len(ids)), lang
    for k in range(1, longest + 1):
        if k > 1:
            inside = start + k - 1 < len(ids)
            start, code = start[inside], code[inside]
            inside = parent[start] == parent[start + k - 1]
            start, code = start[inside], code[inside]
        key = code * v + ids[start + k - 1]
        code, _ = pd.factorize(key)
        first, total = added(key, count[start])
        at = start[first]
        grams = words.take(pa.array(ids[at]))
        h = mix64(name_hash[lang[at]] + word_hash[ids[at]]) if len(at) else np.zeros(0, np.uint64)
        for j in range(1, k):
            grams = pc.binary_join_element_wise(grams, words.take(pa.array(ids[at + j])), " ")
            h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word_hash[ids[at + j]])
        yield names.take(pa.array(lang[at])), grams, total, h


def counted(distinct: DataFrame, buckets: int, least: int = LEAST, longest: int = LONGEST, duck_mb: int = DUCK_MB) -> DataFrame:
    """lang, g, f: n-grams that occur `least` times or more in pieces; g "" has the number of words."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for b in _by_bytes(batches, CHUNK_BYTES):
            tables, edges = [], []  # one for each length, in order of buckets
            for lang, grams, counts, hashes in ngrams(b, longest):
                bucket = (hashes % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                tables.append(pa.table([lang, grams, pa.array(counts)], schema=_BLOB).take(pa.array(order)))
                edges.append(np.searchsorted(bucket[order], np.arange(buckets + 1)))
            del lang, grams, counts, hashes, bucket, order
            for i in np.flatnonzero(np.diff(edges).sum(axis=0)).tolist():
                own = [t.slice(e[i], e[i + 1] - e[i]) for t, e in zip(tables, edges) if e[i + 1] > e[i]]
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _BLOB, options=options) as out:
                    out.write_table(pa.concat_tables(own).combine_chunks())
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["bucket", "blob"])
            del tables
            pa.default_memory_pool().release_unused()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def unpacked():
            for b in batches:
                for blob in b.column("blob"):
                    with pa.ipc.open_stream(blob.as_buffer()) as stream:
                        yield from stream

        with tempfile.TemporaryDirectory() as spill, duckdb.connect(config={"threads": 1, "memory_limit": f"{duck_mb}MB", "temp_directory": spill, "preserve_insertion_order": False}) as duck:
            duck.register("grams", pa.RecordBatchReader.from_batches(_BLOB, unpacked()))
            got = duck.sql(f"SELECT lang, g, sum(c)::BIGINT AS f FROM grams GROUP BY ALL HAVING sum(c) >= {int(least)}")
            yield from got.to_arrow_reader(16_384)
        pa.default_memory_pool().release_unused()

    blobs = map_arrow(distinct.select("lang", "piece", "c"), deal, "bucket int, blob binary")
    return map_arrow(blobs.repartitionById(buckets, "bucket"), count, "lang string, g string, f long")


def mine(docs: DataFrame, least: int = LEAST, kept: int = KEPT, covered: int = 50, scratch: Scratch | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's `kept` best phrases.

    A phrase goes if its words lie inside a longer candidate that has `covered` per cent of its occurrences.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "collocations", shuffled=True)
    distinct = scratch.save(pieces(docs), "pieces")
    size = distinct.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"  # a bucket's blobs are few rows, so their number alone bounds nothing
    before = spark.conf.get(limit)
    spark.conf.set(limit, BATCH_BYTES)
    try:
        counts = scratch.save(counted(distinct, buckets, least), "counts")
    finally:
        spark.conf.set(limit, before)
    scratch.drop("pieces")

    words = F.split("g", " ")
    phrases = counts.where("g <> ''").select("lang", F.col("g").alias("phrase"), F.col("f").alias("a"), words.alias("w")).where("size(w) > 1")
    # each cut asks for both of its parts
    sides = F.expr("flatten(transform(sequence(1, size(w) - 1), k -> array(named_struct('k', k, 'left', true, 'part', concat_ws(' ', slice(w, 1, k))), named_struct('k', k, 'left', false, 'part', concat_ws(' ', slice(w, k + 1, size(w)))))))")
    asked = phrases.select("lang", "phrase", "a", F.explode(sides).alias("q")).select("lang", "phrase", "a", "q.k", "q.left", "q.part")
    told = asked.join(counts.select("lang", F.col("g").alias("part"), "f"), ["lang", "part"])
    cuts = told.groupBy("lang", "phrase", "a", "k").agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
    whole = "(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    scored = cuts.withColumn("score", F.expr(whole)).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))

    # candidates inside longer ones
    inner = F.expr("flatten(transform(sequence(2, size(w) - 1), n -> transform(sequence(1, size(w) - n + 1), i -> concat_ws(' ', slice(w, i, n)))))")
    longer = phrases.where("size(w) > 2").select("lang", F.col("a").alias("longer"), F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = scored.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {int(covered)} * a")
    best = Window.partitionBy("lang").orderBy(F.desc("m.score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= kept)
    totals = counts.where("g = ''").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), "n", F.col("m.score").alias("score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read(spark, sf_dir, "documents", "lang", "text"))


def brute_force(rows: list[tuple[str | None, str | None]], least: int = LEAST, kept: int = KEPT, covered: int = 50) -> list[tuple]:
    """The query's rows in plain Python, for tests; rows: lang and text."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in (text or "").encode().translate(_TABLE).split(b"\n"):
            w = [x for x in piece.split(b" ") if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    found = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    out = []
    for (lang, w), a in found.items():
        if any(t[0] == lang and len(t[1]) > len(w) and 100 * c >= covered * a and any(t[1][i : i + len(w)] == w for i in range(len(t[1]) - len(w) + 1)) for t, c in found.items()):
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))  # noqa: E741
        out.append((lang, -score, -a, b" ".join(w), l, r))
    out.sort()
    rank, got = Counter(), []
    for lang, score, a, phrase, l, r in out:  # noqa: E741
        rank[lang] += 1
        if rank[lang] <= kept:
            got.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return got


SQL = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
), distinct_pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w, count(*) AS c FROM pieces GROUP BY ALL
), places AS (
  SELECT lang, w, c, unnest(generate_series(1, len(w))) AS i FROM distinct_pieces
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g, sum(c)::HUGEINT AS f
  FROM places, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k AS words, g, string_split(g, ' ') AS w, f AS a FROM grams WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, g, a, words, cut, array_to_string(w[1:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y FROM candidates c, (SELECT unnest([1, 2]) AS cut) WHERE cut < words
), scored AS (
  SELECT u.lang, u.g, u.a, u.words, u.cut, p.f AS l, q.f AS r, (1000000::HUGEINT * u.a * u.a) // (p.f * q.f) AS score
  FROM cuts u JOIN grams p ON p.lang = u.lang AND p.g = u.x JOIN grams q ON q.lang = u.lang AND q.g = u.y
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g, a AS longer FROM candidates WHERE words = 3
), covered AS (
  SELECT lang, g, max(longer) AS longer FROM inside GROUP BY ALL
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.g) AS rank, s.g AS phrase, s.a::BIGINT AS a, s.l::BIGINT AS l, s.r::BIGINT AS r, t.n::BIGINT AS n, s.score::BIGINT AS score
FROM lowest s JOIN totals t ON t.lang = s.lang LEFT JOIN covered v ON v.lang = s.lang AND v.g = s.g
WHERE v.longer IS NULL OR 100 * v.longer < 50 * s.a
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.g) <= 2000
"""
