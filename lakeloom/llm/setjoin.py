"""Components of sets that are alike, by a grouped prefix join.

Sets are ordered by one global order, frequent elements last; two sets that link share an element of their
prefixes. Nodes (distinct sets) with one prefix and one size are a group. Groups meet in the buckets of
their prefix elements:

1. Star: each group meets its bucket's leader, the group whose prefix is the most frequent. Group pairs
   pass the size filter and the positional filter, then members are verified on their whole sets.
2. Rest: in buckets whose groups aren't all in one component yet, each group that isn't wholly in the
   leader's component meets the groups of its size class and the next ones that pass the filters. Pairs
   that are joined already are left out, as they can't change a component. No other pair can link, so the
   components are exact.

So a large group of near copies costs as many pairs as it has members, not their square.

With sketches, pairs that can't link are left out before their whole sets travel: a bit that one sketch has and
the other lacks is an element that the sets don't share, so no link is lost.

With parts=True a bucket is one length partition of an element: partition p holds the sizes between two
powers of the ratio, and each set also stands in the next, so sets whose sizes rule out a link never meet.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch
from lakeloom.llm.components import components

#: Words of 64 bits of a sketch.
SKETCH = 16


def size_class(n: str, num: int, den: int) -> Column:
    """Sizes of one class differ by less than den / num; sets that link are in one class or in neighbours."""
    return F.floor(F.log(F.col(n).cast("double")) / log(den / num) + 1e-9).cast("int")


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    x, y = sets.select(F.col("k").alias("a"), F.col("s").alias("x")), sets.select(F.col("k").alias("b"), F.col("s").alias("y"))
    both = F.size(F.array_intersect("x", "y")).cast("long")
    got = pairs.join(x, "a").join(y, "b")
    return got.where(both * (num + den) >= num * (F.size("x") + F.size("y"))).select("a", "b")


def sketch(s: str) -> Column:
    """A bitmap of a column of sets of 32-bit hashes: the first four bits of a hash name one of SKETCH words, the last six its bit."""
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    word = lambda w: F.aggregate(F.filter(s, lambda h: F.shiftright(h, 28) == w), F.lit(0).cast("long"), lambda a, h: a.bitwiseOR(bit(h)))
    return F.transform(F.sequence(F.lit(0), F.lit(SKETCH - 1)), word)


def plausible(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that may link: sets that do differ in few elements, and so do their sketches (k, n, sketch)."""
    x, y = (sketches.select(F.col("k").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"sketch{k}")) for k in "ab")
    unlike = F.aggregate(F.zip_with("sketcha", "sketchb", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda c, d: c + d)
    got = pairs.join(x, "a").join(y, "b")
    return got.where(unlike * (num + den) <= (F.col("na") + F.col("nb")) * (den - num)).select("a", "b")


def linked_components(nodes: DataFrame, whole_sets: Callable[[DataFrame], DataFrame], num: int, den: int, scratch: Scratch, parts: bool = False, sketches: DataFrame | None = None) -> DataFrame:
    """(k, component) of the nodes that link with another; a component is its smallest k.

    nodes: k, n (size, at least 1), weight (how frequent the prefix is), prefix (elements of the set, the
    first in the global order). whole_sets gives (k, s) for a frame of k. sketches: k, n, sketch of every node. Two
    sets link when den * intersection >= num * union.
    """
    on = ["s", "p"] if parts else ["s"]
    # groups: nodes with one prefix and one size, named after their least node
    nodes = nodes.withColumn("sign", F.sha2(F.concat_ws(",", F.col("prefix").cast("array<string>")), 256))
    nodes = scratch.save(nodes, "nodes")
    named = nodes.groupBy("sign", "n").agg(F.min("k").alias("g"), F.first("weight").alias("weight"), F.first("prefix").alias("prefix"), F.count("*").alias("members"))
    groups = scratch.save(named, "groups")
    members = scratch.save(nodes.select("k", "sign", "n").join(groups.select("sign", "n", "g", "members"), ["sign", "n"]).select("k", "g", "members"), "members")
    scratch.drop("nodes")

    places = groups.select("g", "n", "weight", F.posexplode("prefix").alias("pos", "s"))
    if parts:
        own = size_class("n", num, den)
        places = places.withColumn("p", F.explode(F.array(own, own + 1)))
    lead = places.groupBy(*on).agg(F.count("*").alias("c"), F.max(F.struct("weight", "g", "n", "pos")).alias("lead")).where("c > 1")
    lead = scratch.save(lead.select(*on, F.col("lead.g").alias("lg"), F.col("lead.n").alias("ln"), F.col("lead.pos").alias("lpos")), "lead")
    buckets = scratch.save(places.drop("weight").join(lead, on), "buckets")

    def fits(n1, p1, n2, p2):
        sizes = (F.col(n1) * den >= F.col(n2) * num) & (F.col(n2) * den >= F.col(n1) * num)
        room = F.least(F.col(n1) - F.col(p1), F.col(n2) - F.col(p2))
        return sizes & (room * (num + den) >= (F.col(n1) + F.col(n2)) * num)

    mine = members.select(F.col("g").alias("gb"), F.col("k").alias("b"))
    star = buckets.where(F.col("g") != F.col("lg")).where(fits("n", "pos", "ln", "lpos")).select(F.col("lg").alias("a"), F.col("g").alias("gb")).distinct()
    star = star.join(mine, "gb").select("a", "b")
    within = members.where((F.col("members") > 1) & (F.col("k") != F.col("g"))).select(F.col("g").alias("a"), F.col("k").alias("b"))
    star = scratch.save(star.unionByName(within), "star")
    if sketches is not None:
        star = scratch.save(plausible(star, sketches, num, den), "star_left")
    wanted = star.select(F.col("a").alias("k")).unionByName(star.select(F.col("b").alias("k"))).distinct()
    sets = scratch.save(whole_sets(wanted), "sets")
    edges = scratch.save(verified(star, sets, num, den), "edges")
    scratch.drop("sets", *[n for n in ("star", "star_left") if n in scratch.paths])
    joined = scratch.save(components(edges, scratch), "joined")

    # the rest: pairs of groups that aren't all in one component
    owners = members.join(joined.select(F.col("node").alias("k"), "component"), "k", "left").select("k", "g", F.coalesce("component", "k").alias("component"))
    owners = scratch.save(owners, "owners")
    spans = owners.groupBy("g").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    # a leader leads at most as many buckets as its prefix is long, so its component goes by the bucket
    mains = lead.select(*on, "lg").join(spans.select(F.col("g").alias("lg"), F.col("low").alias("main")), "lg").drop("lg")
    spread = buckets.drop("lg", "ln", "lpos").join(spans, "g").join(mains, on)
    open_ = spread.groupBy(*on).agg(F.min("low").alias("x"), F.max("high").alias("y")).where("x < y").select(*on)
    spread = scratch.save(spread.join(open_, on), "spread")
    own = size_class("n", num, den)
    first = spread.where("low <> main or high <> main").select(*on, F.explode(F.array(own - 1, own, own + 1)).alias("c"), F.col("g").alias("g1"), F.col("n").alias("n1"), F.col("pos").alias("p1"), F.col("low").alias("l1"), F.col("high").alias("h1"))
    second = spread.select(*on, own.alias("c"), F.col("g").alias("g2"), F.col("n").alias("n2"), F.col("pos").alias("p2"), F.col("low").alias("l2"), F.col("high").alias("h2"))
    apart = (F.col("g1") != F.col("g2")) & ~((F.col("l1") == F.col("h1")) & (F.col("l2") == F.col("h2")) & (F.col("l1") == F.col("l2")))
    pairs = first.join(second, [*on, "c"]).where(apart & fits("n1", "p1", "n2", "p2")).select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2")).distinct()
    pairs = pairs.unionByName(spans.where("low <> high").select(F.col("g").alias("g1"), F.col("g").alias("g2")))
    left = owners.select(F.col("g").alias("g1"), F.col("k").alias("a"), F.col("component").alias("ca"))
    right = owners.select(F.col("g").alias("g2"), F.col("k").alias("b"), F.col("component").alias("cb"))
    rest = pairs.join(left, "g1").join(right, "g2").where((F.col("ca") != F.col("cb")) & ((F.col("g1") != F.col("g2")) | (F.col("a") < F.col("b")))).select("a", "b")
    rest = scratch.save(rest, "rest")
    scratch.drop("buckets", "spread", "lead")
    if sketches is not None:
        rest = scratch.save(plausible(rest, sketches, num, den), "rest_left")
    wanted = rest.select(F.col("a").alias("k")).unionByName(rest.select(F.col("b").alias("k"))).distinct()
    sets = scratch.save(whole_sets(wanted), "sets")
    more = scratch.save(verified(rest, sets, num, den), "more")
    scratch.drop("sets", *[n for n in ("rest", "rest_left") if n in scratch.paths])
    stars = joined.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return scratch.save(components(stars.unionByName(more), scratch), "final").select(F.col("node").alias("k"), "component")
