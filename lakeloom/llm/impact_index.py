"""Ranked lexical search by a bit-sliced impact index.

1. Texts are cut into terms, a chunk at once; documents become blocks of BLOCK documents, each with its own
   term list and postings (place in the block and occurrences). A fixed bitmap of BITS hash slots says which
   terms may be in a query; it only saves space: others that share a slot are stored and never asked for.
   All documents are in blocks, and every number of the corpus (N, L, document frequencies) counts all.
2. Queries come in batches of bounded size (QUERY_TERMS terms); each batch is sent to all tasks, and so are the
   weights of its terms. A task turns a block's postings into bit slices: for each term a bitmap of the
   block's documents for each bit of the weighted impact.
3. Slices of a query's terms are added by carry-save arithmetic on whole bitmaps (xor for the sum, majority
   for the carry) and one ripple at the end. The best K are found from the most significant slice down:
   documents with the bit set replace the candidates as long as there are more than K of them. Documents lie
   in a block by ascending id, so of equal scores the first bits win.
4. A task keeps the best K of a query over its blocks; these meet by query.

All is exact: slices hold every bit of the integer scores.

Edge cases: null and empty texts, and texts of separators, have no term: such documents aren't counted and
such items get no rows; a null doc_id comes first among equal scores; rows that share a doc_id (or repeat) are
ranked each; items that share an item_id but not the text are ranked each, repeated items once; a document of
any length is one row of its block; no documents or no items give no rows; other columns aren't read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, chunks, map_arrow, read, text_bytes

K = 20
#: Documents a block; a multiple of 64.
BLOCK = 4096
#: Slots of the bitmap of query terms: 128 KiB, whatever the queries.
BITS = 1 << 20
#: Distinct (item, term) pairs a batch of queries.
QUERY_TERMS = 100_000
#: Terms whose slices are made at once.
TERMS_AT_ONCE = 64
#: Term bytes as they are, A-Z lower-cased, all else a blank. Bytes from 128 on are parts of other letters.
_TABLE = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))
_BLOCKS = "docs array<long>, no_id array<boolean>, sizes array<long>, terms array<binary>, dfs array<long>, places binary, tfs binary"


def terms_of(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms of all texts, and each one's row."""
    data, offsets = text_bytes(values)
    flat = pa.py_buffer(data.tobytes().translate(_TABLE))
    texts = pa.Array.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()), flat])
    split = pc.split_pattern(texts, b" ")
    rows, terms = pc.list_parent_indices(split).to_numpy(), split.flatten()
    real = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(real), rows[real.to_numpy(zero_copy_only=False)]


def slot(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) % BITS


def query_slots(items: DataFrame) -> np.ndarray:
    """The bitmap of hash slots of the items' terms; at most BITS numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            terms, _ = terms_of(b.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(sorted({slot(t) for t in terms.unique().to_pylist()}), pa.int32())], ["slot"])

    bits = np.zeros(BITS, bool)
    bits[[r.slot for r in map_arrow(items.select("text"), run, "slot int").distinct().collect()]] = True
    return np.packbits(bits)


def blocks(docs: DataFrame, slots: np.ndarray, block: int = BLOCK) -> DataFrame:
    """A row for each block of documents with terms: ids, sizes, and the postings of terms that queries may have."""
    sent = docs.sparkSession.sparkContext.broadcast(slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(sent.value).astype(bool)
        ids, no_id, sizes, postings, known = [], [], [], [], {}

        def flush():
            # by ascending id, those without one first
            order = np.lexsort((np.array(ids, np.int64), ~np.array(no_id, bool)))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            doc, term, tf = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*postings)) if postings else (np.zeros(0, np.int64),) * 3
            place = rank[doc]
            by = np.lexsort((place, term))
            dfs = np.bincount(term, minlength=len(known)).astype(np.int64)
            pick = lambda x: [[x[i] for i in order.tolist()]]
            return pa.RecordBatch.from_arrays(
                [pa.array(pick(ids), pa.list_(pa.int64())), pa.array(pick(no_id), pa.list_(pa.bool_())), pa.array(pick(sizes), pa.list_(pa.int64())), pa.array([list(known)], pa.list_(pa.binary())), pa.array([dfs.tolist()], pa.list_(pa.int64())), pa.array([place[by].astype(np.uint16).tobytes()], pa.binary()), pa.array([tf[by].astype(np.uint32).tobytes()], pa.binary())],
                ["docs", "no_id", "sizes", "terms", "dfs", "places", "tfs"],
            )

        for b in chunks(batches, "text"):
            terms, rows = terms_of(b.column("text"))
            coded = terms.dictionary_encode()
            code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
            size = np.bincount(rows, minlength=b.num_rows)
            asked = np.array([w for w, t in enumerate(words) if wanted[slot(t)]], np.int64)
            named = np.full(len(words) + 1, -1, np.int64)
            named[asked] = np.arange(len(asked))
            here = named[code] >= 0
            key, tf = np.unique(rows[here] * max(1, len(asked)) + named[code[here]], return_counts=True)
            row, term = np.divmod(key, max(1, len(asked)))
            own = b.column("doc_id").cast(pa.int64()).to_pylist()
            full = np.flatnonzero(size)  # documents without terms aren't ranked or counted
            for part in np.split(full, np.arange(block - len(ids), len(full), block)):
                if len(ids) == block:
                    yield flush()
                    ids, no_id, sizes, postings, known = [], [], [], [], {}
                if not len(part):
                    continue
                number = np.full(b.num_rows, -1, np.int64)
                number[part] = len(ids) + np.arange(len(part))
                mine = number[row] >= 0
                used = np.unique(term[mine])
                globally = np.full(max(1, len(asked)), -1, np.int64)
                globally[used] = [known.setdefault(words[asked[t]], len(known)) for t in used.tolist()]
                postings.append((number[row[mine]], globally[term[mine]], tf[mine]))
                ids += [own[i] or 0 for i in part.tolist()]
                no_id += [own[i] is None for i in part.tolist()]
                sizes += size[part].tolist()
        if ids:
            yield flush()

    return map_arrow(docs.select("doc_id", "text"), run, _BLOCKS)


def impacts(tf: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(1e9 tf) div (1000 tf + 12 m), m = 75 + (25 size N) div L; in whole numbers."""
    m = np.array([75 + 25 * int(s) * n_docs // n_terms for s in sizes], object).astype(np.int64)
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * m)


def sliced(values: np.ndarray) -> np.ndarray:
    """Bit slices (..., 64, words) of numbers (..., 64 * words): slice i has bit i of each number."""
    octets = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(*values.shape, 8)
    bits = np.unpackbits(octets, axis=-1, bitorder="little")
    packed = np.packbits(np.swapaxes(bits, -1, -2), axis=-1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def added(numbers: list[np.ndarray]) -> np.ndarray:
    """The sum of bit-sliced numbers (slices, words): three become two by xor and majority, the last two by ripple."""
    total, carry = numbers[0], np.zeros_like(numbers[0])
    for x in numbers[1:]:
        half = total ^ carry
        moved = np.empty_like(x)
        moved[0] = 0
        np.bitwise_or(total[:-1] & carry[:-1], half[:-1] & x[:-1], out=moved[1:])
        total, carry = half ^ x, moved
    if len(numbers) > 2 or carry.any():
        out, c = np.empty_like(total), np.zeros_like(total[0])
        for i in range(len(total)):
            half = total[i] ^ carry[i]
            out[i] = half ^ c
            c = (total[i] & carry[i]) | (half & c)
        total = out
    return total


def ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def top(total: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest numbers above 0; of equal ones the first."""
    sure, open_ = np.zeros_like(total[0]), np.bitwise_or.reduce(total)
    for i in range(len(total) - 1, -1, -1):
        both = sure | (open_ & total[i])
        n = ones(both)
        if n > k:
            open_ = open_ & total[i]
        else:
            sure, open_ = both, open_ & ~total[i]
            if n == k:
                open_ = np.zeros_like(open_)
                break
    places = lambda b: np.flatnonzero(np.unpackbits(b.view(np.uint8), bitorder="little"))
    first = places(sure)
    return np.concatenate([first, places(open_)[: k - len(first)]])


def numbers_at(total: np.ndarray, places: np.ndarray) -> list[int]:
    bits = (total[:, places // 64] >> (places % 64).astype(np.uint64)) & np.uint64(1)
    return [sum(int(x) << i for i, x in enumerate(column)) for column in bits.T.tolist()]


def search_block(block: dict, queries: list[tuple[int, list[tuple[bytes, int]]]], weights: dict[bytes, int], n_docs: int, n_terms: int, k: int) -> Iterator[tuple[int, np.ndarray, list[int]]]:
    """For each query (its number; terms and repeats) the places of its best documents and their scores."""
    edges = np.concatenate([[0], np.cumsum(block["dfs"])])
    at = {t: i for i, t in enumerate(block["terms"]) if t in weights}
    if not at:
        return
    places, tfs = np.frombuffer(block["places"], np.uint16).astype(np.int64), np.frombuffer(block["tfs"], np.uint32)
    value = impacts(tfs, np.asarray(block["sizes"])[places], n_docs, n_terms)
    width = -(-len(block["sizes"]) // 64) * 64
    # as many slices as the largest score that these queries can have
    most = max(sum(weights[t] * c for t, c in terms if t in weights) for _, terms in queries) * 1_000_000
    depth = max(1, int(most).bit_length())
    if depth > 63:
        raise OverflowError("a query's scores pass 63 bits")
    slices, names = {}, list(at)
    for i in range(0, len(names), TERMS_AT_ONCE):
        some = names[i : i + TERMS_AT_ONCE]
        dense = np.zeros((len(some), width), np.uint64)
        for j, t in enumerate(some):
            a, b = edges[at[t]], edges[at[t] + 1]
            dense[j, places[a:b]] = value[a:b] * weights[t]
        for t, s in zip(some, sliced(dense)):
            slices[t] = s[:depth].copy()
    for number, terms in queries:
        mine = [(t, c) for t, c in terms if t in slices]
        parts = []
        for t, c in mine:  # repeats: the slices shifted by each bit of their number
            for bit in range(c.bit_length()):
                if c >> bit & 1:
                    moved = slices[t] if not bit else np.concatenate([np.zeros_like(slices[t][:bit]), slices[t][:-bit]])
                    parts.append(moved)
        if parts:
            total = added(parts)
            best = top(total, k)
            if len(best):
                yield number, best, numbers_at(total, best)


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK, query_terms: int = QUERY_TERMS, scratch: Scratch | None = None) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item (item_id, text)."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "impact-index", shuffled=True)
    items = items.select("item_id", "text")
    index = scratch.save(blocks(docs, query_slots(items), block), "index")
    n_docs, n_terms = index.agg(F.sum(F.size("docs")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n_docs, n_terms = n_docs or 0, n_terms or 0

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            terms, rows = terms_of(b.column("text"))
            counts = Counter(zip(rows.tolist(), terms.to_pylist()))
            rows = pa.array([r for r, _ in counts], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("item_id").cast(pa.int64()).take(rows), b.column("text_hash").take(rows), pa.array([t for _, t in counts], pa.binary()), pa.array(list(counts.values()), pa.int64())], ["item_id", "text_hash", "term", "times"])

    once = items.withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["item_id", "text_hash"])
    wanted = map_arrow(once, asked, "item_id long, text_hash long, term binary, times long")
    found = index.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.dfs").alias("df"))
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weighed = scratch.save(wanted.join(found, "term").withColumn("weight", weight), "weighed")

    # batches of queries: whole items, dealt by a hash
    batches = max(1, -(-weighed.count() // query_terms))
    batch = F.pmod(F.xxhash64("item_id", "text_hash"), F.lit(batches)).cast("int")
    weighed = scratch.save(weighed.withColumn("batch", batch), "asked", "batch") if batches > 1 else weighed.withColumn("batch", F.lit(0))

    parts = []
    for i in range(batches):
        rows = weighed.where(F.col("batch") == i).drop("batch").toArrow()
        queries, weights = {}, {}
        for r in rows.to_pylist():
            queries.setdefault((r["item_id"], r["text_hash"]), []).append((r["term"], r["times"]))
            weights[r["term"]] = r["weight"]
        names = sorted(queries, key=repr)
        sent = spark.sparkContext.broadcast((names, [(n, sorted(queries[q])) for n, q in enumerate(names)], weights))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, queries, weights = sent.value
            best: dict[int, list] = {}
            for b in batches:
                for j in range(b.num_rows):
                    row = {c: b.column(c)[j] for c in b.schema.names}
                    one = {c: np.array(row[c].values) if c in ("docs", "sizes", "dfs") else row[c].as_py() for c in row}
                    for number, places, scores in search_block(one, queries, weights, n_docs, n_terms, k):
                        held = best.setdefault(number, [])
                        held += [(-s, not one["no_id"][p], int(one["docs"][p])) for p, s in zip(places.tolist(), scores)]
                        if len(held) > 8 * k:
                            best[number] = heapq.nsmallest(k, held)
            for number, held in best.items():
                held = heapq.nsmallest(k, held)
                item, text = names[number]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(held), pa.int64()), pa.array([text] * len(held), pa.int64()), pa.array([d if has else None for _, has, d in held], pa.int64()), pa.array([-s for s, _, _ in held], pa.int64())], ["item_id", "text_hash", "doc_id", "score"])

        parts.append(map_arrow(index, run, "item_id long, text_hash long, doc_id long, score long"))
    got = parts[0]
    for p in parts[1:]:
        got = got.unionByName(p)
    best = Window.partitionBy("item_id", "text_hash").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return got.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark", "item_id", "text"))


SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), sized AS (
  SELECT doc_id, len(w)::BIGINT AS n, w FROM d WHERE len(w) > 0
), whole AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sized
), postings AS (
  SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM sized) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * (SELECT docs FROM whole) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM postings GROUP BY term
), asked AS (
  SELECT item_id, term, count(*)::BIGINT AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
  ) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), whole GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
