"""Near duplicates by SetSketch registers: banded, estimated by likelihood, verified on whole sets.

A document is its set of hashed word n-grams (64 bits). Each n-gram has one point for each of M registers:
ascending, exponentially spaced, dealt by a permutation of the registers that depends on the n-gram. A register
keeps the least point of the set as a logarithm to base B, truncated to a whole number, so registers of a union
are the maxima of its parts' registers (`merge`), and registers of two sets are equal about as often as their
Jaccard similarity. Points above the largest that a register holds change nothing, so a set of n costs about
n + M log M points instead of n * M.

1. Equal sets are one node. BAND registers make a band; nodes that share one are a bucket. Sets of a similarity
   of 0.8 share none of the 51 bands with a probability of 2e-9, and at most one with 4e-8.
2. Star: a bucket's members meet its leader, the member whose bands are shared most: of near copies that is
   what they were copied from. The pair's similarity is estimated by likelihood from how many registers are
   larger, smaller and equal; pairs within SLACK (6 standard deviations) of the limit are verified on whole sets.
   Stars repeat on buckets that aren't in one component yet, each with a leader of a component that hasn't led
   there, as long as they join something.
3. Rest: in buckets that are still open, members of different components meet if their sizes allow a link,
   they share at least two bands, and at most UNLIKE of their registers differ in the last bit (10 % do at 0.8;
   the limit is 6 standard deviations above). N-grams that no other member of open buckets has are in no
   intersection, and hashed bitmaps of the others bound what two sets share from above, so copies that differ
   much from each other never make a pair. Each pair that is left is made once, then estimated and verified.

So a large group of near copies costs as many pairs as it has members. No bucket is capped.

Edge cases: a document with fewer words than n has one n-gram, its whole sequence; null and wordless texts have
an empty set and stay alone; rows that share a doc_id (or have none) are nodes by their texts; a null doc_id names
a component only if nothing else is in it; repeated rows are one node; an empty table gives no rows; other
columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, chunks, map_arrow, mix64, read
from lakeloom.llm.components import components
from lakeloom.llm.ngram_jaccard import shingle_sets, whole_sets
from lakeloom.llm.setjoin import verified

#: Registers of a sketch: a power of two.
M = 256
#: Base of the logarithms; registers hold 0 to 65,535, which spans 65 orders of e.
B = 1.001
#: Registers a band.
BAND = 5
#: Pairs estimated this far below the limit are still verified; the estimate's deviation is 0.025 at 0.8.
SLACK = 0.15
#: Last bits of M registers that may differ.
UNLIKE = 55
#: Words of 64 bits of a bitmap of n-grams.
WORDS = 16
#: A task sketches this many n-grams at once.
AT_ONCE = 1_000_000
_TOP = 65_535
#: Rounds of stars at most; what they leave open goes to the rest.
STARS = 2
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _registers_of(points: np.ndarray) -> np.ndarray:
    """floor(1 - log_B x), shifted so that the sets of up to e^40 n-grams fit: 0 for an empty register."""
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(points) / np.log(B) + 20 / np.log(B))
    return np.clip(k, 0, _TOP).astype(np.uint16)


def sketch(elements: np.ndarray, owner: np.ndarray, sets: int, m: int = M) -> np.ndarray:
    """Registers (sets, m) of elements (64-bit hashes) that belong to sets numbered by owner."""
    least = np.full(sets * m, np.inf)
    seed, who = mix64(elements ^ _GOLDEN), owner.astype(np.int64)
    odd, shift = mix64(seed + np.uint64(1)), mix64(seed + np.uint64(2))
    a, b = (odd & np.uint64(m - 1)) | np.uint64(1), ((odd >> np.uint64(20)) & np.uint64(m - 1)) | np.uint64(1)
    c, d = shift & np.uint64(m - 1), (shift >> np.uint64(20)) & np.uint64(m - 1)
    half = np.uint64(max(1, m.bit_length() // 2))
    at = np.zeros(len(seed))
    for j in range(m):
        if not len(seed):
            break
        seed = mix64(seed + _GOLDEN)
        # spacings of the order statistics of m exponential variables
        at = at - np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / (m - j)
        # a permutation of the registers, its j-th member: odd multiples and shifts are bijections
        r = (np.uint64(j) * a + c) & np.uint64(m - 1)
        r = ((r ^ (r >> half)) * b + d) & np.uint64(m - 1)
        np.minimum.at(least, who * m + r.astype(np.int64), at)
        # points only grow: an element beyond every register of its set is done
        alive = at < least.reshape(sets, m).max(axis=1)[who]
        if not alive.all():
            seed, who, at = seed[alive], who[alive], at[alive]
            a, b, c, d = a[alive], b[alive], c[alive], d[alive]
    return _registers_of(least.reshape(sets, m))


def merge(a: bytes, b: bytes) -> bytes:
    """The registers of the union of two sets."""
    return np.maximum(np.frombuffer(a, np.uint16), np.frombuffer(b, np.uint16)).tobytes()


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, points: int = 128) -> np.ndarray:
    """Jaccard similarity of pairs from their registers (rows of x and y) and set sizes, by maximum likelihood.

    A register of x is larger with probability p(u - v J), smaller with p(v - u J), where u and v are the shares
    of the sizes and p(t) = -log_B(1 - t (B - 1) / B); all registers count at once.
    """
    more, less = (x > y).sum(axis=1), (x < y).sum(axis=1)
    same = x.shape[1] - more - less
    u = nx / (nx + ny)
    v = 1 - u
    most = np.minimum(u / v, v / u)[:, None]
    j = np.linspace(0, 1, points + 1)[None, :] * most * (1 - 1e-12)

    def p(t: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(t, 0, 1) * (B - 1) / B) / np.log(B)

    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    tiny = 1e-300
    likely = more[:, None] * np.log(up + tiny) + less[:, None] * np.log(down + tiny) + same[:, None] * np.log(np.maximum(1 - up - down, 0) + tiny)
    return np.take_along_axis(j, likely.argmax(axis=1)[:, None], 1)[:, 0]


def sketched(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, text_hash, k (the set's 128-bit key), n (its size), registers and their last bits of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            own = shingle_sets(b.column("text"), n)
            sizes = np.array([len(s) for s in own], np.int64)
            registers, bits = [], []
            for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(np.cumsum(sizes) // AT_ONCE)) + 1):
                flat = np.concatenate([own[i] for i in part]) if len(part) else np.zeros(0, np.uint64)
                rows = sketch(flat, np.repeat(np.arange(len(part)), sizes[part]), len(part))
                registers += [r.tobytes() for r in rows]
                bits += np.packbits((rows & 1).astype(np.uint8), axis=1).view(np.int64).tolist()
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in own]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), b.column("text_hash"), pa.array(keys, pa.binary()), pa.array(sizes), pa.array(registers, pa.binary()), pa.array(bits, pa.list_(pa.int64()))], ["doc_id", "text_hash", "k", "n", "registers", "bits"])

    return map_arrow(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), run, "doc_id long, text_hash long, k binary, n long, registers binary, bits array<long>")


def likely(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose registers put their similarity at `least` or more."""
    x = nodes.select(F.col("k").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra"))
    y = nodes.select(F.col("k").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ra, rb = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1) for c in ("ra", "rb"))
                j = estimate(ra, rb, b.column("na").to_numpy(), b.column("nb").to_numpy())
                yield b.select(["a", "b"]).filter(pa.array(j >= least))

    return map_arrow(pairs.join(x, "a").join(y, "b"), run, "a binary, b binary")


def link(docs: DataFrame, n: int = 2, num: int = 80, den: int = 100, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, text_hash, n_shingles, component (its key, null for an empty set), component_id of every row."""
    scratch = scratch or Scratch(docs.sparkSession, "setsketch", shuffled=True)
    docs = docs.select("doc_id", "text")
    rows = scratch.save(sketched(docs, n), "rows")
    nodes = scratch.save(rows.where("n > 0").groupBy("k").agg(F.first("n").alias("n"), F.first("registers").alias("registers"), F.first("bits").alias("bits")), "distinct")
    ids = scratch.save(rows.drop("registers", "bits"), "ids")
    scratch.drop("rows")

    def sizes_fit(a: str, b: str):
        return (F.col(a) * den >= F.col(b) * num) & (F.col(b) * den >= F.col(a) * num)

    bands = F.transform(F.sequence(F.lit(0), F.lit(M // BAND - 1)), lambda i: F.xxhash64(i, F.expr("registers").substr(i * (2 * BAND) + 1, F.lit(2 * BAND))))
    places = nodes.select("k", "n", F.explode(bands).alias("s"))
    shared = scratch.save(places.groupBy("s").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    places = scratch.save(places.join(shared, "s"), "places")
    # from here on only nodes that share a band with another: their registers and whole sets
    nodes = scratch.save(nodes.join(places.select("k").distinct(), "k"), "active")
    sets = scratch.save(whole_sets(docs, ids, nodes.select("k"), n), "sets")
    weights = places.groupBy("k").agg(F.sum("c").alias("weight"))
    buckets = scratch.save(places.drop("c").join(weights, "k").withColumn("component", F.col("k")), "buckets0")
    scratch.drop("shared", "places", "distinct")

    def confirmed(pairs: DataFrame, name: str) -> DataFrame:
        hopeful = scratch.save(likely(pairs, nodes, num / den - SLACK), f"hopeful{name}")
        edges = scratch.save(verified(hopeful, sets, num, den), f"edges{name}")
        scratch.drop(f"hopeful{name}")
        return edges

    edges, led, joined = None, None, None
    for r in range(STARS):
        # a component leads a bucket once
        fresh_ = buckets if led is None else buckets.join(led, ["s", "component"], "left_anti")
        lead = fresh_.groupBy("s").agg(F.max(F.struct("weight", "k", "n", "component")).alias("lead"))
        lead = scratch.save(lead.select("s", F.col("lead.k").alias("a"), F.col("lead.n").alias("na"), F.col("lead.component").alias("ca")), f"lead{r}")
        pairs = buckets.join(lead, "s").where((F.col("component") != F.col("ca")) & sizes_fit("n", "na")).select("a", F.col("k").alias("b"))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        new = confirmed(pairs, str(r))
        if not new.limit(1).count():
            break
        edges = new if edges is None else edges.unionByName(new)
        stars = new if joined is None else new.unionByName(joined.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))
        joined = scratch.save(components(stars, scratch), f"joined{r}")
        # buckets that are in one component are done
        now = buckets.drop("component").join(joined.select(F.col("node").alias("k"), "component"), "k", "left").withColumn("component", F.coalesce("component", "k"))
        now = scratch.save(now, f"now{r}")
        left = now.groupBy("s").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("s")
        buckets = scratch.save(now.join(left, "s"), f"buckets{r + 1}")
        led_now = lead.select("s", F.col("a").alias("k")).join(joined.select(F.col("node").alias("k"), "component"), "k", "left").select("s", F.coalesce("component", "k").alias("component"))
        led = led_now if led is None else led_now.unionByName(led).distinct()
        scratch.drop(f"now{r}", f"buckets{r}")

    # the rest: two bands or more in common, in different components, most registers' last bits alike, and room for
    # a link among the n-grams that others in open buckets have too
    once = buckets.groupBy("k").agg(F.sort_array(F.collect_set("s")).alias("bands"), F.first("n").alias("n"), F.first("component").alias("component")).where("size(bands) > 1")
    once = scratch.save(once, "once")
    elements = sets.join(once.select("k"), "k").select("k", F.explode("s").alias("e"))
    common = elements.groupBy("e").agg(F.count("*").alias("c")).where("c > 1").select("e")
    # of those a bitmap: a bit that one set has and the other lacks is an element that they don't share
    slot = F.pmod(F.xxhash64("e"), F.lit(64 * WORDS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot % 64)
    words = [F.bit_or(F.when(F.floor(slot / 64) == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"w{i}") for i in range(WORDS)]
    room = elements.join(common, "e").groupBy("k").agg(F.count("*").alias("room"), *words)
    once = once.join(scratch.save(room, "room"), "k").where(F.col("room") * den >= F.col("n") * num).join(nodes.select("k", *[F.col("bits")[i].alias(f"v{i}") for i in range(M // 64)]), "k")
    couples = once.withColumn("s", F.explode("bands"))
    # members of a bucket's largest component meet the others, but not each other
    each = couples.groupBy("s", "component").agg(F.count("*").alias("c"))
    main = each.groupBy("s").agg(F.max(F.struct("c", "component")).alias("m"), F.count("*").alias("components")).where("components > 1")
    couples = couples.join(main.select("s", F.col("m.component").alias("main")), "s").withColumn("is_main", F.col("component") == F.col("main")).drop("bands", "main")
    couples = scratch.save(couples, "couples")
    # plain columns that are never NULL keep the join's test short enough to be compiled
    plain = ["component", "n", "room", "is_main", *[f"w{i}" for i in range(WORDS)], *[f"v{i}" for i in range(M // 64)]]
    zero = lambda c: F.lit(False) if c == "is_main" else F.lit(b"") if c == "component" else F.lit(0).cast("long")
    couples = couples.select("s", "k", *[F.coalesce(c, zero(c)).alias(c) for c in plain])
    other = couples.select("s", *[F.col(c).alias(f"{c}_b") for c in ("k", *plain)])
    unlike = sum((F.bit_count(F.col(f"v{i}").bitwiseXOR(F.col(f"v{i}_b"))) for i in range(M // 64)), F.lit(0))
    lacks = lambda x, y: sum((F.bit_count(F.col(f"w{i}{x}").bitwiseAND(F.bitwise_not(F.col(f"w{i}{y}")))) for i in range(WORDS)), F.lit(0))
    shared_at_most = F.least(F.col("room") - lacks("", "_b"), F.col("room_b") - lacks("_b", ""))
    enough = shared_at_most * (num + den) >= (F.col("n") + F.col("n_b")) * num
    apart = (F.col("component") != F.col("component_b")) & (F.col("is_main_b") | (F.col("k") < F.col("k_b"))) & sizes_fit("n", "n_b") & (unlike <= UNLIKE) & enough
    apart = couples.where("not is_main").join(other, "s").where(apart)
    # a row for each band in common
    apart = apart.groupBy(F.least("k", "k_b").alias("a"), F.greatest("k", "k_b").alias("b")).agg(F.count("*").alias("c")).where("c > 1").select("a", "b")
    more = confirmed(apart, "rest")
    if more.limit(1).count():
        stars = more if joined is None else more.unionByName(joined.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))
        joined = scratch.save(components(stars, scratch), "joined")

    # rows without words share one empty set, and meet nobody
    worded = ids.where("n > 0")
    if joined is None:
        worded = worded.withColumn("component", F.col("k"))
    else:
        worded = worded.join(joined.select(F.col("node").alias("k"), "component"), "k", "left").withColumn("component", F.coalesce("component", "k"))
    worded = scratch.save(worded, "worded")
    names = worded.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    got = worded.join(names, "component").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component", "component_id")
    alone = ids.where("n = 0").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.lit(None).cast("binary").alias("component"), F.col("doc_id").alias("component_id"))
    return got.unionByName(alone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = link(read(spark, sf_dir, "documents", "doc_id", "text"), 2, 80, 100)
    return got.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) >= 2 THEN concat(w[i], ' ', w[i + 1]) ELSE w[1] END AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, least(len(w), 1)))) AS i FROM worded)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = d.doc_id
"""
