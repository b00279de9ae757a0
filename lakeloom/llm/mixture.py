"""Mixing sources to target weights by a low-discrepancy source schedule.

The mix is a row of slots of `block` words each, as many as hold all words. Slot i holds the point
frac((i + 1) * golden ratio) mapped through the cumulative target shares, which names its source. Slots are
ranked within their source; the slot of rank r takes the r-th block of the source's stream: its documents
in a seeded shuffle, end to end, again from the start when it ends, up to `epochs` times. So the points
decide how much of each source is taken, which documents, and where in the mix they stand.

Targets are water-filled: shares by weight, at most `epochs` times the source's size, the excess shared
again by weight. Every stretch of the mix holds each source's share to a few blocks (the points'
discrepancy), and so does the whole; a corpus has about SLOTS slots, until blocks reach BLOCK_TOKENS words.

Edge cases: null text counts 0 words; null source is a source of its own, last; rows of one doc_id stay
separate rows, ordered by their text, rows without doc_id are shuffled by their text; rows equal in doc_id,
source and text are interchangeable; documents without words are taken 0 times; an empty table gives no
rows. Reruns agree: order comes from md5(doc_id) and the text alone. The driver holds the catalogue of
sources (a name and five numbers each), nothing of documents; MAX_SOURCES bounds it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, any_order, fresh, map_arrow, quoted, read, schema_of, text_bytes, workers_path

BLOCK_TOKENS = 1024
#: Slots of a mix whose blocks are smaller than BLOCK_TOKENS.
SLOTS = 1 << 20
MAX_EPOCHS = 3
#: Sources (rows of the catalogue of sources) the driver may hold; more is an error, not a cut.
MAX_SOURCES = 1_000_000
#: Documents that one bucket of a source holds on average.
BUCKET_DOCS = 2_000
SEED = 7

_GOLDEN = 0x9E3779B97F4A7C15  # 2**64 / golden ratio, odd


def count_words(values: pa.Array) -> np.ndarray:
    """Number of `[^\\x20\\x09-\\x0D]+` in each text; null: 0."""
    data, offsets = text_bytes(values)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.empty(len(data), dtype=bool)
    if len(data):
        first[0], first[1:] = True, space[:-1]
    starts = np.flatnonzero(~space & first)
    # a word that begins where a text begins is a word, whatever the text before ended with
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts = np.union1d(starts, begins[~space[begins]])
    return np.diff(np.searchsorted(starts, offsets)).astype(np.int64)


def water_fill(sizes: list[int], weights: list[int], epochs: int = MAX_EPOCHS) -> list[float]:
    """Targets that share sum(sizes) by weight, none above epochs * size."""
    total, free = sum(sizes), set(range(len(sizes)))
    share = 0.0
    while free:
        share = (total - sum(epochs * sizes[i] for i in range(len(sizes)) if i not in free)) / sum(weights[i] for i in free)
        over = {i for i in free if weights[i] * share > epochs * sizes[i]}
        if not over:
            break
        free -= over
    return [weights[i] * share if i in free else float(epochs * sizes[i]) for i in range(len(sizes))]


def code_point_weights(n: int) -> list[int]:
    """1, 2, 3, 1, 2, 3, ... for sources in order."""
    return [1 + i % 3 for i in range(n)]


def running_sum(df: DataFrame, by: str, order: str, value: str, step: int = 4096) -> DataFrame:
    """df with `base`, the sum of `value` over the smaller `order` of its `by`, in two levels, so that no task sorts all."""
    part = F.floor(F.col(order) / step)
    sums = df.groupBy(by, part.alias("_part")).agg(F.sum(value).alias("_n"))
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(by, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(by, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    got = df.withColumn("_part", part).withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return got.join(sums, [by, "_part"]).withColumn("base", F.col("_before") + F.col("_within")).drop("_part", "_before", "_within")


def golden(i: np.ndarray) -> np.ndarray:
    """The points of slots i (uint64) in [0, 1)."""
    return ((i + np.uint64(1)) * np.uint64(_GOLDEN)).astype(np.float64) / 2.0**64


def schedule(spark: SparkSession, targets: list[float], slots: int, points: Callable[[np.ndarray], np.ndarray] = golden) -> DataFrame:
    """(slot, src, rank) of all slots: the source that each slot's point falls to, and the how manieth of it."""
    workers_path(spark)
    shares = np.cumsum(np.array(targets)) / max(sum(targets), 1e-300)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            i = b.column(0).to_numpy()
            src = np.minimum(np.searchsorted(shares, points(i.astype(np.uint64)), side="right"), len(shares) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(src.astype(np.int32))], ["slot", "src"])

    dealt = spark.range(0, slots, 1, max(1, min(slots // 200_000 + 1, 100_000))).mapInArrow(deal, "slot long, src int")
    # ranks: slots of a stretch are counted first, so a source's rows never meet in one task
    stretch = (F.col("slot") / 16384).cast("long")
    counts = running_sum(dealt.groupBy("src", stretch.alias("stretch")).agg(F.count("*").alias("n")), "src", "stretch", "n")
    within = Window.partitionBy("src", "stretch").orderBy("slot")
    ranked = dealt.withColumn("stretch", stretch).join(counts.drop("n"), ["src", "stretch"])
    return ranked.select("slot", "src", (F.col("base") + F.row_number().over(within) - 1).alias("rank"))


def place(docs: DataFrame, scratch: Scratch, block_tokens: int, epochs: int, seed: int, weights: Callable[[int], list[int]]) -> tuple[DataFrame, list[float], int, int]:
    """Each row's place in its source's stream; the sources' targets, words a block, slots of the mix."""

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("source"), pa.array(count_words(b.column("text"))), b.column("text_hash")], ["doc_id", "source", "size", "text_hash"])

    thin = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("text_hash"))
    thin = scratch.save(map_arrow(thin, sized, "doc_id long, source string, size long, text_hash long"), "sized")
    per = thin.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).limit(MAX_SOURCES + 1).collect()
    if len(per) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per = sorted(per, key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in per]
    targets = water_fill(sizes, weights(len(per)), epochs)
    block = max(1, min(block_tokens, -(-sum(sizes) // SLOTS)))
    rows = [(r.source, j, r["size"], targets[j], max(1, r["docs"] // BUCKET_DOCS)) for j, r in enumerate(per)]
    catalogue = docs.sparkSession.createDataFrame(rows, "source string, src int, source_size long, target double, buckets long")

    # each document's place in its source's stream: buckets of the shuffled order first, then within
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id"), F.col("text_hash")).cast("string")))
    placed = thin.join(catalogue, thin.source.eqNullSafe(catalogue.source), "left").drop(catalogue.source)
    placed = placed.withColumn("shuffle_key", key)
    # buckets follow the order of the key: its first 32 bits, scaled
    placed = placed.withColumn("bucket", F.shiftright(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long") * F.col("buckets"), 32))
    sums = running_sum(placed.groupBy("src", "bucket").agg(F.sum("size").alias("n")), "src", "bucket", "n").drop("n")
    within = Window.partitionBy("src", "bucket").orderBy("shuffle_key", F.col("doc_id").asc_nulls_first(), "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(sums, ["src", "bucket"]).withColumn("start", F.col("start") + F.col("base"))
    placed = scratch.save(placed.select("doc_id", "source", "text_hash", "size", "src", "source_size", "target", "start"), "placed")
    return placed, targets, block, -(-sum(sizes) // block)


#: What tells rows apart (copies by start, unless they have no words), and what goes with them.
_ROW = ["doc_id", "text_hash", "source", "src", "start", "size", "source_size", "target"]


def pieces(placed: DataFrame, slots: DataFrame, block: int, epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix in pieces: slot, rank, a row's columns, and the words first to first + words of its text that stand there."""
    # the stream as often as it may go round; a row meets the blocks that its words lie in
    turned = placed.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    turned = turned.withColumn("at", F.col("start") + F.col("epoch") * F.col("source_size"))
    ranks = F.sequence(F.floor(F.col("at") / block).cast("long"), F.floor((F.col("at") + F.col("size") - 1) / block).cast("long"))
    met = turned.withColumn("rank", F.explode(ranks)).join(slots, ["src", "rank"])
    low = F.greatest(F.col("at"), F.col("rank") * block)
    high = F.least(F.col("at") + F.col("size"), (F.col("rank") + 1) * block)
    return met.select("slot", "rank", *_ROW, (low - F.col("at")).alias("first"), (high - low).alias("words"))


def mix(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, epochs: int = MAX_EPOCHS, seed: int = SEED, weights: Callable[[int], list[int]] = code_point_weights, scratch: Scratch | None = None, points: Callable[[np.ndarray], np.ndarray] = golden) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target, taken, first_slot of every row.

    What a source takes is a prefix of its stream, some times round, so a row is taken whole taken // size
    times, and its first taken % size words once more. first_slot is where the mix first takes it.
    """
    scratch = scratch or Scratch(docs.sparkSession, "mixture")
    placed, targets, block, slots = place(docs, scratch, block_tokens, epochs, seed, weights)
    dealt = schedule(docs.sparkSession, targets, slots, points)
    # rows that the mix leaves out stand beside its pieces with no words
    left_out = placed.select(F.lit(None).cast("long").alias("slot"), *_ROW, F.lit(0).cast("long").alias("words"))
    both = pieces(placed, dealt, block, epochs).select("slot", *_ROW, "words").unionByName(left_out)
    worded = both.where("size > 0").groupBy(*_ROW).agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    empty = placed.where("size = 0").select(*_ROW, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot"))
    return worded.unionByName(empty).select("doc_id", "source", "text_hash", "size", "source_size", "target", "taken", "first_slot")


def in_slot_order(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, epochs: int = MAX_EPOCHS, seed: int = SEED, weights: Callable[[int], list[int]] = code_point_weights, scratch: Scratch | None = None) -> DataFrame:
    """The mix as it is to be read: slot, source, rank, doc_id, text_hash, first, words, in order of slot and place."""
    scratch = scratch or Scratch(docs.sparkSession, "mixture")
    placed, targets, block, slots = place(docs, scratch, block_tokens, epochs, seed, weights)
    got = pieces(placed, schedule(docs.sparkSession, targets, slots), block, epochs)
    return got.orderBy("slot", "start").select("slot", "source", "rank", "doc_id", "text_hash", "first", "words")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents", "doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def cut_words(text: str, n: int) -> str:
    """The text up to the end of its n-th word."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    last = np.flatnonzero(~space & np.append(space[1:], True))
    return text if n >= len(last) else data[: last[n - 1] + 1].tobytes().decode() if n > 0 else ""


def take_texts(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mixed corpus: each document's row as often as it is taken whole, and a row cut to the rest.

    `docs` keeps its columns (n_chars follows the cut); documents that aren't taken go. Rows that agree
    in doc_id, source and text are numbered on both sides, so each has its own share; the numbers follow
    the other columns, so which row has which share doesn't depend on the run.
    """
    hash_, nth_, id_, source_, found_, number_, size_, taken_, words_ = fresh(docs, *(f"_mix_{n}" for n in ("hash", "nth", "id", "source", "found", "number", "size", "taken", "words")))
    left = docs.withColumn(hash_, F.xxhash64("text"))
    left = left.withColumn(nth_, F.row_number().over(Window.partitionBy("doc_id", "source", hash_).orderBy(any_order(docs, "text"))))
    number = F.row_number().over(Window.partitionBy("doc_id", "source", "text_hash").orderBy("taken"))
    right = mixed.where("size > 0").select(F.col("doc_id").alias(id_), F.col("source").alias(source_), F.col("text_hash").alias(found_), number.alias(number_), F.col("size").alias(size_), F.col("taken").alias(taken_))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(source_)) & (F.col(hash_) == F.col(found_)) & (F.col(nth_) == F.col(number_))
    whole = F.floor(F.col(taken_) / F.col(size_)).cast("int")
    rest = F.col(taken_) % F.col(size_)
    lengths = F.concat(F.array_repeat(F.lit(-1).cast("long"), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>")))
    columns = docs.columns
    got = left.join(right.hint("merge"), same).select(*map(quoted, columns), F.explode(lengths).alias(words_))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column(words_).to_pylist()
            texts = b.column("text")
            if any(n >= 0 for n in words):
                texts = pa.array([t if n < 0 else cut_words(t, n) for t, n in zip(texts.to_pylist(), words)], pa.string())
            yield pa.RecordBatch.from_arrays([texts if c == "text" else b.column(c) for c in columns], columns)

    out = map_arrow(got, cut, schema_of(docs))
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in columns else out


SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(concat('{SEED}:', CAST(doc_id AS VARCHAR))) AS k FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM docs GROUP BY source
), fill(step, share) AS (
  SELECT 0, CAST(sum(source_size) AS DOUBLE) / CAST(sum(w) AS DOUBLE) FROM per
  UNION ALL
  SELECT step + 1, (SELECT CAST(sum(source_size) - sum(CASE WHEN w * share > {MAX_EPOCHS} * source_size THEN {MAX_EPOCHS} * source_size ELSE 0 END) AS DOUBLE)
                    / CAST(greatest(1, sum(CASE WHEN w * share > {MAX_EPOCHS} * source_size THEN 0 ELSE w END)) AS DOUBLE) FROM per)
  FROM fill WHERE step < 30
), final AS (SELECT share FROM fill WHERE step = 30),
targets AS (
  SELECT source, source_size, CASE WHEN w * share > {MAX_EPOCHS} * source_size THEN CAST({MAX_EPOCHS} * source_size AS DOUBLE) ELSE w * share END AS target FROM per, final
), bounds AS (
  SELECT source, lead(low, 1, 2.0) OVER (ORDER BY source NULLS LAST) AS high, low FROM (
    SELECT source, coalesce(sum(target) OVER (ORDER BY source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(target) OVER () AS low FROM targets)
), extent AS (
  SELECT block, CAST(ceil(words / block) AS BIGINT) AS slots FROM (SELECT words, CAST(greatest(1, least({BLOCK_TOKENS}, ceil(words / {SLOTS}))) AS BIGINT) AS block FROM (SELECT coalesce(sum(size), 0) AS words FROM docs))
), points AS (
  SELECT i, CAST((CAST(i + 1 AS HUGEINT) * {_GOLDEN}) % 18446744073709551616 AS DOUBLE) / 18446744073709551616.0 AS x FROM (SELECT unnest(range(slots)) AS i FROM extent)
), ranked AS (
  SELECT b.source, p.i AS slot, row_number() OVER (PARTITION BY b.source ORDER BY p.i) - 1 AS rank FROM points p JOIN bounds b ON p.x >= b.low AND p.x < b.high
), takes AS (
  SELECT t.*, e.block, least(coalesce(r.n, 0) * e.block, {MAX_EPOCHS} * source_size) AS take
  FROM targets t CROSS JOIN extent e LEFT JOIN (SELECT source, count(*) AS n FROM ranked GROUP BY source) r ON r.source IS NOT DISTINCT FROM t.source
), placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target, t.take, t.block,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM docs d JOIN takes t ON d.source IS NOT DISTINCT FROM t.source
), mixed AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE CAST((take // source_size) * size + greatest(0, least(start + size, take % source_size) - start) AS BIGINT) END AS taken FROM placed
)
SELECT m.doc_id, CAST(m.size AS BIGINT) AS size, m.source_size, m.target, m.taken, r.slot AS first_slot
FROM mixed m LEFT JOIN ranked r ON m.taken > 0 AND r.source IS NOT DISTINCT FROM m.source AND r.rank = m.start // m.block
"""
