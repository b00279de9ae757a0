"""SpotSigs fingerprints, with DataFrame functions alone.

A signature is a common word (anchor) and the chain of the next CHAIN content words after it, common words
skipped. In the list of a text's words, the anchor that is the j-th common word and stands at place p
has p - j content words before it, so its chain is content[p - j], content[p - j + 1], ...: one linear
pass each for anchors, content and signatures. A document's fingerprint is its set of hashed signatures
in order; a text with words but no whole chain has one signature, of all its words.

Likeness is the Jaccard coefficient of two fingerprints. Near copies are found among all documents:
near_groups() partitions distinct fingerprints by set length, so sizes that rule out the threshold never
meet, compares them through their prefixes and pruned Jaccard (setjoin), and names what hangs together.
The prefixes hold a set's rarest signatures by the counts of COUNTED hash slots; the order needs only to
be the same everywhere, so a slot that several signatures share costs time, not links.

Edge cases: null text counts as empty; a text without words has an empty fingerprint and is near nobody;
the likeness of two empty fingerprints is 1, of an empty and another 0; equal doc_ids are ordered by their
text, null ids come first; the document after the last is the first, so a lone document follows itself;
classes are named by their fingerprints, so rows that share a doc_id or have none keep their own; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, read
from lakeloom.llm.setjoin import linked_components, sketch

CHAIN = 2
#: Anchors: common words of the languages at hand. A parameter of signatures().
ANCHORS = tuple(
    "a an and are as at be by for from has have he in is it of on or that the this to was were which with you "
    "als auch auf aus das dem den der des die ein eine einer es für im ist mit nicht sich sie und von zu "
    "au avec ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une "
    "al como con del el ella es esta la las lo los más no o para por que se su una y".split()
)
#: Characters of text that one range of documents holds, and most ranges.
RANGE_CHARS = 3_000_000
MAX_RANGES = 4096
#: Near copies: likeness of at least this many hundredths.
THRESHOLD = 80
#: Hash slots in which signatures are counted, a power of 2; their counts are all that reaches the driver.
COUNTED = 1 << 16
#: Columns of hexadecimal digits.
HEXED = ("edited_sha256", "fingerprint", "edited_fingerprint")


def word_list(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def with_signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN, anchors: tuple = ANCHORS) -> DataFrame:
    """Adds the sorted set of signature hashes (32 bits in a long) of a text column."""
    w, c, s = f"_{out}_words", f"_{out}_content", f"_{out}_found"
    common = sorted(set(anchors))
    df = df.withColumn(w, word_list(F.col(text)))
    df = df.withColumn(c, F.filter(w, lambda x: ~x.isin(common)))
    places = F.filter(F.transform(w, lambda x, i: F.when(x.isin(common), i)), lambda i: i.isNotNull())
    df = df.withColumn(s, places)

    def signature(p: Column, j: Column) -> Column:
        return F.xxhash64(F.get(w, p), *[F.get(c, p - j + k) for k in range(chain)])

    whole = F.filter(s, lambda p, j: p - j + chain <= F.size(c))
    found = F.transform(whole, signature)
    alone = F.when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))
    found = F.when(F.size(whole) > 0, found).otherwise(alone)
    short = F.transform(found, lambda h: h.bitwiseAND(F.lit(0xFFFFFFFF)))
    return df.withColumn(out, F.sort_array(F.array_distinct(short))).drop(w, c, s)


def as_string(signatures: Column) -> Column:
    """A fingerprint: 8 hexadecimal digits for each signature, in order."""
    return F.array_join(F.transform(signatures, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def likeness(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard coefficient, or 0 where sizes alone put it under the threshold."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b)).cast("double")
    return F.when(large == 0, 1.0).when((small == 0) | (small < threshold * large), 0.0).otherwise(both / (small + large - both))


def ranges(docs: DataFrame) -> DataFrame:
    """The rows dealt into consecutive doc_id ranges (_range), each followed by the first of the next (_tail)."""
    stats = docs.agg(F.sum(F.length("text")).alias("chars"), F.min("doc_id").alias("first"), F.count("*").alias("n"), F.count("doc_id").alias("ids")).first()
    n = max(1, min(MAX_RANGES, (stats.chars or 0) // RANGE_CHARS + 1))
    cuts: list[int] = []
    if n > 1 and stats.ids:
        cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n + 1000)).first()[0]
        cuts = sorted(set(cuts) - {stats.first})
    first = None if stats.n > stats.ids else stats.first
    rank = _count_upto(F.col("doc_id"), cuts)
    starts = F.col("doc_id").isin(cuts) if cuts else F.lit(False)
    own = F.struct(rank.alias("_range"), F.lit(False).alias("_tail"))
    before = F.struct((rank - 1).alias("_range"), F.lit(True).alias("_tail"))
    last = F.struct(F.lit(len(cuts)).alias("_range"), F.lit(True).alias("_tail"))
    where = F.array_compact(F.array(own, F.when(starts, before), F.when(F.col("doc_id").eqNullSafe(F.lit(first)), last)))
    return docs.select("*", F.inline(where))


def _count_upto(value: Column, cuts: list[int], step: int = 64) -> Column:
    """How many cuts are at most the value (null: 0), in two short searches."""
    if not cuts:
        return F.lit(0)
    blocks = [cuts[i : i + step] for i in range(0, len(cuts), step)]
    heads = F.array(*[F.lit(b[0]).cast("long") for b in blocks])
    block = F.size(F.filter(heads, lambda c: c <= value)) - 1
    table = F.array(*[F.array(*[F.lit(c).cast("long") for c in b]) for b in blocks])
    count = block * step + F.size(F.filter(F.get(table, block), lambda c: c <= value))
    return F.when(value.isNull() | (block < 0), 0).otherwise(count).cast("int")


def fingerprints(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of (doc_id, text), and its signatures (sigs)."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    w = Window.partitionBy("_range").orderBy("_tail", F.col("doc_id").asc_nulls_first(), "text")
    df = ranges(base).withColumn("_next", F.lead("text").over(w))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.coalesce("_next", F.lit("")), F.lit(1), half))
    df = df.withColumn("edited", edited).drop("_next")
    df = with_signatures(df, "text", "_own")
    df = with_signatures(df, "edited", "_edited")
    df = df.withColumn("_following", F.lead("_own").over(w)).where(~F.col("_tail"))
    return df.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("_own")).alias("fingerprint"),
        as_string(F.col("_edited")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_edited")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_following")).alias("near_next"),
        F.col("_own").alias("sigs"),
    )


def frequencies(sets: DataFrame) -> Column:
    """How frequent a signature's hash slot is (log2), as an array that is the same for all rows."""
    slot = F.col("s").bitwiseAND(COUNTED - 1)
    counted = sets.select(F.explode("s").alias("s")).groupBy(slot.cast("int").alias("slot")).agg(F.count("*").alias("n"))
    levels = {r.slot: r.level for r in counted.select("slot", F.floor(F.log2("n")).cast("int").alias("level")).collect()}
    # one foldable expression, so that it is a constant of the plan and read in place
    return F.split(F.lit(",".join(str(levels.get(i, 0)) for i in range(COUNTED))), ",").cast("array<int>")


def near_groups(sets: DataFrame, scratch: Scratch, hundredths: int = THRESHOLD) -> DataFrame:
    """(k, near) of the fingerprints k that are near another; near is the least k of what hangs together.

    sets: k (a fingerprint's key) and s (its signatures), one row a fingerprint that has any.
    """
    levels = frequencies(sets)
    n = F.size("s")
    order = F.sort_array(F.transform("s", lambda h: F.struct(F.get(levels, h.bitwiseAND(COUNTED - 1).cast("int")).alias("level"), h.alias("h"))))
    keep = n - F.ceil(n * hundredths / 100 - 1e-9).cast("int") + 1
    nodes = sets.select("k", n.cast("long").alias("n"), F.slice(order, F.lit(1), keep).alias("first"))
    nodes = nodes.select("k", "n", F.aggregate("first", F.lit(0), lambda a, x: a + x["level"]).alias("weight"), F.transform("first", lambda x: x["h"]).alias("prefix"))
    sketches = scratch.save(sets.select("k", n.cast("long").alias("n"), sketch("s").alias("sketch")), "sketches")
    found = linked_components(nodes, lambda wanted: sets.join(wanted, "k", "left_semi"), hundredths, 100, scratch, parts=True, sketches=sketches)
    return found.withColumnRenamed("component", "near")


def with_groups(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The contract's columns of every row, class_id (least doc_id of an equal fingerprint) and near_id (least reachable through near copies).

    Fingerprints are made twice, once to group them and once for the result, so that only the signatures of each distinct one are written down.
    """
    key = F.unhex(F.md5(as_string(F.col("sigs"))))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    signed = with_signatures(base, "text", "sigs").select("doc_id", "sigs", key.alias("k"))
    sets = scratch.save(signed.groupBy("k").agg(F.first("sigs").alias("s"), F.min("doc_id").alias("class_id")), "distinct")
    sets = sets.where(F.size("s") > 0)
    near = near_groups(sets.select("k", "s"), scratch)
    classes = sets.select("k", "class_id")
    classes = scratch.save(classes.join(near, "k", "left").select("k", "class_id", F.coalesce("near", "k").alias("near")), "classes")
    named = classes.join(classes.groupBy("near").agg(F.min("class_id").alias("near_id")), "near").select("k", "class_id", "near_id")
    named = scratch.save(named, "named")
    scratch.drop(*[n for n in scratch.paths if n != "named"])
    # bytes, written down: the window's shuffle is gone when the join's comes, and a signature takes 4 bytes in both
    got = scratch.save(fingerprints(docs).drop("sigs").withColumns({c: F.unhex(c) for c in HEXED}), "printed")
    # rows without words share one empty fingerprint, and are near nobody; they meet no key, each in its own place
    alone = F.length("fingerprint") == 0
    spread = F.unhex(F.md5(F.concat_ws(":", F.lit("none"), F.col("doc_id").cast("string"), F.lower(F.hex("edited_sha256")))))
    key = F.unhex(F.md5(F.lower(F.hex("fingerprint"))))
    got = got.withColumn("k", F.when(alone, spread).otherwise(key)).join(named.hint("merge"), "k", "left").drop("k")
    got = got.withColumns({c: F.when(alone, F.col("doc_id")).otherwise(F.col(c)) for c in ("class_id", "near_id")})
    return got.withColumns({c: F.lower(F.hex(c)) for c in HEXED})


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "spotsigs", shuffled=True)
    return with_groups(read(spark, sf_dir, "documents", "doc_id", "text"), scratch)


def edited_text(text: str | None, following: str | None) -> str:
    """The contract's edit in plain Python, for tests."""
    t = text or ""
    h = len(t) // 2
    return t[: len(t) - h] + (following or "")[:h]


def edited_sha256(text: str | None, following: str | None) -> str:
    return hashlib.sha256(edited_text(text, following).encode()).hexdigest()
