"""Every operator on nulls, empty and very long texts, ties and repeated rows, empty tables, clashing columns."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from lakeloom.llm import language_id, line_dedup, media, mixture, ngram_jaccard, pieces, repeats, spotsigs, toxicity, url_filter
from lakeloom.llm.common import Scratch

LONG = ("the quick brown fox jumps over the lazy dog and runs " * 60 + "\n") * 40
PASSAGE = "It is a truth that a passage of more than fifty words comes again and again in the pages of a corpus " * 4
ROWS = [
    (1, "The cat sat on the mat.\nIt was a good mat.\nAll was well.\nThe end.", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \n\t ", "de", "b"),
    (5, LONG, "en", "a"),
    (6, LONG, "en", "a"),
    (7, "A start.\nThe cat sat on the mat.\nIt was a good mat.\nAll was well.\n" + PASSAGE, None, "b"),
    (8, "Ünïcode ▁ 中文 🙂 <s> words\x00 here " + PASSAGE, "fr", None),
    (9, "one", "es", "c"),
    (9, "one", "es", "c"),
    (9, "another text under the same id " + PASSAGE, "es", "c"),
    (None, "no id at all " + PASSAGE, "en", "b"),
    (-5, "***!!! 123", "en", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = "_text_hash _id _mix_hash _places _row id k n size score h _range".split()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in ROWS]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in CLASHES}).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (5, 0), (7, 1), (9, 1), (None, 1), (8, None), (6, 2), (-5, -1)], "doc_id long, label int")


OPERATORS = {
    "pieces": lambda d, lab: pieces.encode(d),
    "toxicity": lambda d, lab: toxicity.score(d, toxicity.learn(d, lab)),
    "repeats": lambda d, lab: repeats.cut_repeats(d),
    "mixture": lambda d, lab: mixture.mix(d),
    "line_dedup": lambda d, lab: line_dedup.dedup_lines(d)[0],
    "language_id": lambda d, lab: language_id.identify(d, language_id.learn(d)),
    "media": lambda d, lab: media.media_column(d),
    "spotsigs": lambda d, lab: spotsigs.with_groups(d, Scratch(d.sparkSession, "test")),
    "ngram_jaccard": lambda d, lab: ngram_jaccard.link(d, 4, 85, 100),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(docs, labels, name):
    got = OPERATORS[name](docs, labels).toPandas()
    assert sorted(got["doc_id"].fillna(-(10**9)).tolist()) == sorted([-(10**9) if i is None else i for i, *_ in ROWS])


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels).count() == 0


def hashes(df, *columns):
    return [tuple(r) for r in df.select("doc_id", "text", F.xxhash64("text").alias("v"), *columns).collect()]


@pytest.mark.parametrize("most", [repeats.MAX_RUNS, 1])
def test_repeats_by_brute_force(docs, most):
    """Also with null and shared ids, exact copies among them, and a passage amid ever different text."""
    spark = docs.sparkSession
    passage = hashlib.sha512(b"passage").hexdigest() * 2
    more = [(i, f"{k * 7919} before. {passage} after {k * 104729}.") for k, i in enumerate((None, None, 9, 9, 9, 40, 41, 42))] + [(None, "u" + "x7y" * 50), (None, "u" + "x7y" * 50), (9, passage)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string")).repartition(3)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in repeats.cut_repeats(docs, most=most).collect())
    rows = hashes(docs)
    want = repeats.brute_force(rows)
    assert got == sorted((i is not None, i or 0, *want[i, v]) for i, _, v in rows)
    assert any(i is None and n[1] for (i, _), n in want.items())


def test_line_dedup_by_brute_force(docs):
    plain = docs.where("doc_id is not null and doc_id <> 9")
    frame, lines, removed = line_dedup.dedup_lines(plain)
    got = {r["doc_id"]: (r[lines], r[removed], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in frame.collect()}
    assert got == line_dedup.brute_force([(i, t) for i, t, *_ in ROWS if i not in (None, 9)])


def named(rows, component):
    """The least doc_id of each row's component, as sorted (doc_id, name) pairs."""
    ids = {}
    for (i, *_), c in zip(rows, component):
        ids.setdefault(c, []).append(i)
    least = {c: min((i for i in own if i is not None), default=None) for c, own in ids.items()}
    return sorted(((i, least[c]) for (i, *_), c in zip(rows, component)), key=repr)


def with_shared_ids(docs):
    """Copies, near copies and strangers under null and shared ids."""
    near = lambda k: " ".join(f"w{j}" for j in range(60) if j != k)
    more = [(None, near(k % 5)) for k in range(12)] + [(9, near(30 + k)) for k in range(3)] + [(None, f"alone {k} in the dark of night {k}") for k in range(12)] + [(9, f"other {k} by the light of day {k}") for k in range(3)] + [(None, None), (None, "")]
    return docs.select("doc_id", "text").unionByName(docs.sparkSession.createDataFrame(more, "doc_id long, text string")).repartition(4)


def test_links_by_brute_force(docs):
    docs = with_shared_ids(docs)
    rows = hashes(docs)
    want = ngram_jaccard.brute_force([(k, t) for k, (_, t, _) in enumerate(rows)])
    # rows without words stay alone
    component = [want[k][1] if want[k][0] else ("alone", k) for k in range(len(rows))]
    got = ngram_jaccard.link(docs, 4, 85, 100).collect()
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == named(rows, component)
    assert sorted(r.n_shingles for r in got) == sorted(n for n, _ in want.values())


def test_near_fingerprints_by_brute_force(docs):
    docs = with_shared_ids(docs)
    rows = hashes(docs)
    got = spotsigs.with_groups(docs, Scratch(docs.sparkSession, "test")).collect()
    prints = {(r.doc_id, r.fingerprint) for r in got}
    sets = {p: {p[k : k + 8] for k in range(0, len(p), 8)} for _, p in prints if p}
    parent = {p: p for p in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in sets:
        for b in sets:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    own = [(r.doc_id, r.fingerprint) for r in got]
    classes = [p or ("alone", k) for k, (_, p) in enumerate(own)]
    near = [root(p) if p else ("alone", k) for k, (_, p) in enumerate(own)]
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == named(own, classes)
    assert sorted(((r.doc_id, r.near_id) for r in got), key=repr) == named(own, near)
    assert len(got) == len(rows) and len(set(near)) < len(set(classes))


@pytest.fixture
def large_blocks(monkeypatch):
    """Blocks of the full size, as in a corpus of many words."""
    monkeypatch.setattr(mixture, "SLOTS", 1)


def test_mixture_keeps_its_targets(docs, large_blocks):
    """To a few blocks of words, whole texts at most three times; reruns agree."""
    got = mixture.mix(docs, block_tokens=7).toPandas()
    assert (got.taken <= 3 * got["size"]).all()
    per = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"))
    assert (abs(per.taken - per.target) <= 4 * 7).all()
    assert (got.first_slot.isna() == (got.taken == 0)).all()
    again = mixture.mix(docs.orderBy(F.desc("text")), block_tokens=7).toPandas()
    order = ["doc_id", "text_hash", "taken", "first_slot"]
    assert got[order].sort_values(order).values.tolist().__repr__() == again[order].sort_values(order).values.tolist().__repr__()


def test_mixture_in_slot_order(docs, large_blocks):
    """The pieces fill the slots but for where a source ends its last round, and are what each document gives."""
    order = mixture.in_slot_order(docs, block_tokens=7).toPandas()
    assert order.slot.is_monotonic_increasing
    filled = order.groupby("slot").words.sum()
    sizes = mixture.mix(docs, block_tokens=7).toPandas()
    assert (filled <= 7).all() and (filled < 7).sum() <= sizes.source.nunique(dropna=False)
    taken = order.groupby(["doc_id", "text_hash"], dropna=False).words.sum()
    assert taken.sort_index().tolist() == sizes[sizes.taken > 0].groupby(["doc_id", "text_hash"], dropna=False).taken.sum().sort_index().tolist()


def test_another_point_sequence_makes_another_mix(docs):
    a = mixture.mix(docs, block_tokens=7)
    b = mixture.mix(docs, block_tokens=7, points=lambda i: ((i * np.uint64(0xD1342543DE82EF95)) >> np.uint64(11)).astype(np.float64) / 2.0**53)
    x, y = ({(r.doc_id, r.text_hash, r.taken, r.first_slot) for r in d.collect()} for d in (a, b))
    assert x != y and {r[:3] for r in x} != {r[:3] for r in y}


def test_stages_keep_columns(spark, docs, tmp_path):
    sf = tmp_path
    docs.write.parquet(str(sf / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0), (7, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(sf / "labels.parquet"))
    for i, (name, stage) in enumerate(P.STAGES):
        for frame in (docs, docs.limit(0)):
            got = stage(spark, frame, str(sf))
            if i < len(P.STAGES) - 1:
                assert got.columns == docs.columns, name
            assert got.count() <= 3 * docs.count()
    assert P.run(spark, str(sf)).where("not lossless").count() == 0


def test_near_copies_keep_one(spark, docs):
    kept = [(r.doc_id, r.text) for r in P.drop_near_copies(spark, docs, "").select("doc_id", "text").collect()]
    assert kept.count((5, LONG)) == 1 and (6, LONG) not in kept and kept.count((9, "one")) == 1
    assert {(2, None), (3, ""), (4, " \n\t ")} <= set(kept)


def test_urls(spark):
    pages = spark.createDataFrame([(1, None), (2, "no scheme"), (3, "http://A.Example.com/en/7x?q#f"), (4, "x://example.net/de/8"), (5, "x://y.example.net/de/9"), (6, "http://com/en/"), (7, "http://xcom/en/"), (8, "http://a.org"), (9, "u://a.org/es/://b"), (1, None)], "page_id long, url string").withColumn("host", F.lit("clash"))
    want = {1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("a.example.com", "/en/7x", "example.com/en/7", "allow"), 4: ("example.net", "/de/8", "example.net/de/8", "block"), 5: ("y.example.net", "/de/9", "net/de/", "allow"), 6: ("com", "/en/", "com/en/", "block"), 7: ("xcom", "/en/", None, "allow"), 8: ("a.org", "", None, "allow"), 9: ("a.org", "/es/://b", "org/es/", "block")}
    got = url_filter.filter_urls(pages, url_filter.RULES).collect()
    assert len(got) == 10 and {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == want
    none = url_filter.filter_urls(pages, [], "block").collect()
    assert {(r.rule, r.verdict) for r in none} == {(None, "block")} and len(none) == 10
    assert url_filter.filter_urls(pages.limit(0), url_filter.RULES).count() == 0
    whole = url_filter.filter_urls(pages, [("block", "A.org", ""), ("allow", "example.com", "")], "block").collect()
    assert {r.page_id: (r.rule, r.verdict) for r in whole} == {i: ("a.org", "block") if i in (8, 9) else ("example.com", "allow") if i == 3 else (None, "block") for i in range(1, 10)}
    clash = lambda s: 7
    packed = url_filter.DigestArray.pack([(b"a", b"1"), (b"b", b"2"), (b"c\0", b"")], clash)
    colliding = url_filter.DigestArray(np.frombuffer(packed, np.uint8), clash)
    assert colliding.find([b"c\0", b"x", b"a", b"c"]) == [b"", None, b"1", None]
