"""Collocations, the bit-sliced index and set sketches: brute force, arithmetic, edge cases."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_edges import ROWS, SCHEMA, hashes, named, with_shared_ids

from lakeloom.llm import collocations, impact_index, ngram_jaccard, setsketch
from lakeloom.llm.common import Scratch

CLASHES = "_text_hash k g f s c n a b rank score term weight component bucket".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHES}).cache()


# --- 11


def phrases(frame):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in frame.collect())


@pytest.mark.parametrize("least", [2, 10])
def test_collocations_by_brute_force(docs, least):
    random.seed(3)
    words = "alpha Beta gamma ÄÖ x\x00y 中文 of the".split(" ")
    more = [(100 + i, " ".join(random.choice(words) + random.choice(["", ",", "\t", " ;", "\r"]) for _ in range(60)), random.choice([None, "und", "en", ""]), "s", 0) for i in range(40)]
    docs = docs.select(*SCHEMA.replace(" long", "").replace(" string", "").split(", ")).unionByName(docs.sparkSession.createDataFrame([*more, *more[:9]], SCHEMA)).repartition(3)
    want = collocations.brute_force([(r.lang, r.text) for r in docs.collect()], least=least)
    got = phrases(collocations.mine(docs, least=least))
    assert got == sorted(want) and {w[0] for w in want} >= {"und", "en", ""}
    assert phrases(collocations.mine(docs, least=least, kept=3)) == sorted(w for w in want if w[1] <= 3)


def test_collocations_are_exact_beyond_64_bits(spark):
    """Multiplicities of a billion: products pass 64 bits."""
    counts = spark.createDataFrame([("en", "p q", 3_000_000_000), ("en", "q p", 7), ("en", "p", 11)], "lang string, piece string, c long")
    f = {r.g: r.f for r in collocations.counted(counts, 5).collect()}
    assert f == {"": 6_000_000_025, "p": 3_000_000_018, "q": 3_000_000_007, "p q": 3_000_000_000}
    row = spark.createDataFrame([(3_000_000_000, 3_000_000_018, 3_000_000_007)], "a long, l long, r long").selectExpr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0))) as s")
    assert row.first().s == 1_000_000 * 3_000_000_000**2 // (3_000_000_018 * 3_000_000_007)


def test_collocations_spill(spark):
    """A bucket of more than its memory is counted all the same."""
    pieces = spark.range(120_000).selectExpr("'en' as lang", "concat('w', id, ' v', id, ' w', id div 2) as piece", "6L as c")
    got = collocations.counted(pieces, 1, duck_mb=24)
    assert got.where("g <> ''").agg(F.count("*"), F.sum("f")).first()[:] == (60_000, 60_000 * 18)


def test_collocations_hold_one_length_and_few_blobs(spark, docs, monkeypatch):
    """N-grams come length by length; a bucket's blobs go to Python a few megabytes at a time, and no other step's rows do."""
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "en"], "piece": ["a b a", "b"], "c": pa.array([2, 3], pa.int64())})
    made = collocations.ngrams(batch)
    assert iter(made) is made
    assert [sorted(zip(g.to_pylist(), c.tolist())) for _, g, c, _ in made] == [[("", 9)], [("a", 4), ("b", 5)], [("a b", 2), ("b a", 2)], [("a b a", 2)]]
    limit, seen, save = "spark.sql.execution.arrow.maxBytesPerBatch", {}, Scratch.save
    monkeypatch.setattr(Scratch, "save", lambda self, df, name, *by: seen.update({name: spark.conf.get(limit)}) or save(self, df, name, *by))
    before = spark.conf.get(limit)
    collocations.mine(docs)
    assert seen["counts"] == str(collocations.BATCH_BYTES) != before == seen["pieces"] and spark.conf.get(limit) == before


def test_collocations_of_nothing(docs):
    assert collocations.mine(docs.limit(0)).count() == 0
    assert collocations.mine(docs.where("text is null or trim(text) = ''")).count() == 0


# --- 12


def test_bitmaps_add_like_numbers():
    rng = np.random.default_rng(5)
    for parts in (1, 2, 3, 9):
        values = rng.integers(0, 1 << 40, (parts, 128)).astype(np.uint64)
        values[:, ::3] = 0
        total = impact_index.added([s.copy() for s in impact_index.sliced(values)])
        want = values.sum(axis=0)
        assert impact_index.numbers_at(total, np.arange(128)) == want.tolist()
        for k in (1, 20, 127, 200):
            order = sorted(range(128), key=lambda i: (-int(want[i]), i))
            assert sorted(impact_index.top(total, k).tolist()) == sorted(i for i in order[:k] if want[i])


def ranked(rows, items, k=20):
    """Plain Python: (item_id, item's text) to [(score, doc_id)]."""
    split = lambda t: [w for w in (t or "").encode().translate(impact_index._TABLE).split(b" ") if w]
    sizes, tf = [len(split(t)) for _, t in rows], [Counter(split(t)) for _, t in rows]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for c in tf for t in c)
    out = {}
    for item, text in dict.fromkeys(items):
        found = []
        for (doc, _), n, c in zip(rows, sizes, tf):
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // n_terms))) for t in split(text) if c[t])
            if s > 0:
                found.append((-s, doc is not None, doc or 0))
        out[item, text] = [(-s, d if has else None) for s, has, d in sorted(found)[:k]]
    return out


@pytest.mark.parametrize("block, query_terms", [(64, 7), (4096, 100_000)])
def test_search_by_brute_force(docs, block, query_terms):
    spark = docs.sparkSession
    more = [(200 + i % 150, f"The cat {'mat ' * (i % 4)} number {i % 9} sat", None, None, 0) for i in range(300)]
    every = docs.select(*[f.split(" ")[0] for f in SCHEMA.split(", ")]).unionByName(spark.createDataFrame(more, SCHEMA)).repartition(2)
    items = [(1, "the CAT the mat"), (1, "another words"), (2, None), (3, ""), (4, "zzz nowhere"), (5, "Ünïcode 中文 9"), (None, "fox dog"), (1, "the CAT the mat"), (6, "cat " * 70)]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("clash"))
    got = impact_index.search(every.withColumn("tf", F.lit(1)), frame, block=block, query_terms=query_terms).collect()
    want = ranked([(r.doc_id, r.text) for r in every.collect()], items)
    flat = sorted(((i, rank, d, s) for (i, _), best in want.items() for rank, (s, d) in enumerate(best, 1)), key=repr)
    assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=repr) == flat
    assert len(flat) > 40


def test_search_of_nothing(docs):
    items = docs.sparkSession.createDataFrame([(1, "cat")], "item_id long, text string")
    assert impact_index.search(docs.limit(0), items).count() == 0
    assert impact_index.search(docs, items.limit(0)).count() == 0


def test_blocks_hold_all_documents(docs):
    slots = impact_index.query_slots(docs.select(F.lit("cat mat").alias("text")).limit(1))
    got = impact_index.blocks(docs, slots, 64).collect()
    assert sum(len(r.docs) for r in got) == sum(bool(impact_index.terms_of(pa.array([t], pa.string()))[1].size) for _, t, *_ in ROWS)
    assert all(t in (b"cat", b"mat") for r in got for t in r.terms)


# --- 13


def sets(rng, j, n, pairs):
    both = round(2 * n * j / (1 + j))
    draw = lambda k: rng.integers(0, 2**63, k).astype(np.uint64)
    out = [(shared := draw(both), draw(n - both), draw(n - both)) for _ in range(pairs)]
    return [np.concatenate([s, x]) for s, x, _ in out], [np.concatenate([s, y]) for s, _, y in out]


@pytest.mark.parametrize("n", [1, 7, 900])
def test_registers_of_a_union(n):
    rng = np.random.default_rng(n)
    x, y = rng.integers(0, 2**63, n).astype(np.uint64), rng.integers(0, 2**63, 40).astype(np.uint64)
    one = lambda e: setsketch.sketch(e, np.zeros(len(e), np.int64), 1)[0].tobytes()
    assert setsketch.merge(one(x), one(y)) == one(np.concatenate([x, y])) == one(np.concatenate([y, x, y]))


@pytest.mark.parametrize("j", [0.3, 0.8, 0.95])
def test_likelihood_finds_the_similarity(j):
    x, y = sets(np.random.default_rng(8), j, 500, 200)
    owner = np.repeat(np.arange(200), 500)
    a, b = (setsketch.sketch(np.concatenate(s), owner, 200) for s in (x, y))
    got = setsketch.estimate(a, b, np.full(200, 500), np.full(200, 500))
    assert abs(got.mean() - j) < 0.01 and abs(got - j).max() < setsketch.SLACK
    bands = (a == b)[:, : 51 * 5].reshape(200, 51, 5).all(axis=2).sum(axis=1)
    assert j < 0.8 or bands.min() > 1


def test_near_copies_by_brute_force(docs):
    docs = with_shared_ids(docs)
    rows = hashes(docs)
    want = ngram_jaccard.brute_force([(k, t) for k, (_, t, _) in enumerate(rows)], 2, 80, 100)
    component = [want[k][1] if want[k][0] else ("alone", k) for k in range(len(rows))]
    got = setsketch.link(docs).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == named(rows, component)
    assert sorted(r.n_shingles for r in got) == sorted(n for n, _ in want.values())
    assert setsketch.link(docs.limit(0)).count() == 0


@pytest.mark.parametrize("stars", [0, 1, 4])
def test_chains_and_clusters_that_no_leader_joins(spark, monkeypatch, stars):
    """Chains of small edits, whose ends aren't alike, and two clusters that share much without a link; the rest alone finds all too."""
    monkeypatch.setattr(setsketch, "STARS", stars)
    random.seed(11)
    base, rows = [f"w{i}" for i in range(120)], []
    for step in range(30):
        rows.append((step, " ".join(base)))
        for _ in range(4):
            base[random.randrange(120)] = f"n{random.random()}"
    other = [f"v{i}" for i in range(100)]
    for cluster in (0, 1):
        own = other[:70] + [f"c{cluster}x{i}" for i in range(30)]
        for k in range(25):
            copy = list(own)
            copy[random.randrange(100)] = f"e{cluster}{k}"
            rows.append((1000 * (cluster + 1) + k, " ".join(copy)))
    want = ngram_jaccard.brute_force(rows, 2, 80, 100)
    got = setsketch.link(spark.createDataFrame(rows, "doc_id long, text string"), scratch=Scratch(spark, "test", shuffled=True)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) >= 3
