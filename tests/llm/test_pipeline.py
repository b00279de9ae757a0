"""Each stage of the corpus pipeline against plain Python, row by row, on nulls, shared ids, ties and repeats."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from lakeloom.llm import mixture, ngram_jaccard, pieces, toxicity

NEAR = " ".join(f"word{k}" for k in range(40))
BLOCK = "first line of it\nsecond line of it\nthird line of it\nfourth"
ROWS = [
    (1, f"{BLOCK}\nand more\n\n\n\n\nblank", "en", "a"),
    (2, f"x\n{BLOCK}\ny", "en", "a"),
    (3, BLOCK, "en", None),
    (4, None, None, None),
    (5, "", "de", "b"),
    (6, " \n\n\n ", "de", "b"),
    (7, NEAR, "en", "a"),
    (8, NEAR + " tail", "en", "b"),
    (8, NEAR + " tail", "en", "c"),
    (8, NEAR + " tail", "de", "b"),
    (9, "Tie one two three four five", "fr", "c"),
    (9, "tie one TWO three four five", "fr", "c"),
    (None, "no id one two three", "en", "a"),
    (None, "no id one two three", "en", "a"),
    (None, "other text without an id", "en", "c"),
    (None, NEAR, "en", "a"),
    (10, "short", "es", "c"),
    (10, "short", "es", "c"),
    (11, "what vile scum they are", "en", "a"),
    (12, "such scum again", "en", "b"),
    (None, "scum without an id", "en", "b"),
    (13, "a fine day for all of us", "en", "b"),
]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rows = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path_factory.mktemp("sf"))
    more = spark.createDataFrame([(100 + i, ("scum of the town " if i % 5 == 0 else "people of the town " if i % 5 == 1 else "nothing but words ") + f"number {i}", "en", "z", 0) for i in range(200)], docs.schema)
    docs.unionByName(more).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, int(i % 5 == 0)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    return docs.repartition(3).cache(), sf


def rows(df):
    return [tuple(r) for r in df.withColumn("_h", F.xxhash64("text")).collect()]


def bag(got):
    return Counter(tuple(r) for r in got)


def order(r):
    """doc_id (null first), then the text's hash."""
    return (r[0] is not None, r[0] or 0, r[5])


def test_toxicity(spark, corpus):
    docs, sf = corpus
    every = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.learn_from(spark, sf, every)
    got = P.drop_toxic(spark, every, sf).collect()
    want = [tuple(r) for r in every.collect() if model.score(r.text) < 0.5]
    assert bag(got) == bag(want)
    gone = {r.text for r in every.collect()} - {r[1] for r in want}
    assert None not in gone and "" not in gone
    assert {"what vile scum they are", "such scum again", "scum without an id"} <= gone and not any("people" in t or "nothing" in t for t in gone)


def test_line_dedup(spark, corpus):
    docs, sf = corpus
    seen, cut = set(), {}
    for r in sorted({(x[0], x[1], 0, 0, 0, x[5]) for x in rows(docs)}, key=order):
        lines, gone = (r[1] or "").split("\n"), set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        cut[r[0], r[5]] = (len(gone), r[1] if not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone))
    want = []
    for i, t, lang, s, n, h in rows(docs):
        removed, text = cut[i, h]
        if not removed or text.strip():
            want.append((i, text, lang, s, None if text is None else len(text)))
    got = P.drop_lines(spark, docs, sf).collect()
    assert bag(got) == bag(want)
    assert len(want) < len(ROWS) and any(w[0] == 2 and w[1] == "x\ny" for w in want)


def test_near_copies(spark, corpus):
    docs, sf = corpus
    own = rows(docs)
    found = ngram_jaccard.brute_force([(k, r[1]) for k, r in enumerate(own)], 5, 80, 100)
    best = {}
    for k, r in enumerate(own):
        place = (r[0] is None, r[0] or 0, r[5])
        if found[k][0] and (found[k][1] not in best or place < best[found[k][1]]):
            best[found[k][1]] = place
    got = P.drop_near_copies(spark, docs, sf).collect()
    wordless = bag(r[:5] for k, r in enumerate(own) if not found[k][0])
    assert bag(r for r in got if tuple(r) in wordless) == wordless
    stay = sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in got if tuple(r) not in wordless)
    text = {(r[0] is None, r[0] or 0, r[5]): r[1] for r in own}
    assert stay == sorted((*p[:2], text[p]) for p in best.values())
    # of rows equal in doc_id and text the same one stays, whatever the partitions
    again = P.drop_near_copies(spark, docs.repartition(7, "lang"), sf).collect()
    assert bag(got) == bag(again)


def test_mixture(spark, corpus):
    docs, sf = corpus
    own = rows(docs)
    count = lambda t: len((t or "").encode().split())
    sources = sorted({r[3] for r in own}, key=lambda s: (s is None, s or ""))
    sizes = [sum(count(r[1]) for r in own if r[3] == s) for s in sources]
    targets = mixture.water_fill(sizes, [1 + k % 3 for k in range(len(sources))])
    total = sum(sizes)
    points = [((i + 1) * mixture._GOLDEN % 2**64) / 2.0**64 for i in range(total)]  # blocks of one word
    edges = np.cumsum(targets) / sum(targets)
    slots = Counter(min(int(np.searchsorted(edges, x, side="right")), len(sources) - 1) for x in points)
    want = []
    for j, s in enumerate(sources):
        words = min(slots[j], 3 * sizes[j])
        key = lambda r: (hashlib.md5(f"7:{r[5] if r[0] is None else r[0]}".encode()).hexdigest(), r[0] is not None, r[0] or 0, r[5])
        start = 0
        for r in sorted((r for r in own if r[3] == s), key=key):
            n = count(r[1])
            if n:
                whole, rest = words // sizes[j], min(max(words % sizes[j] - start, 0), n)
                if rest == n:
                    whole, rest = whole + 1, 0
                want += [(r[0], r[1], s, len(r[1]))] * whole
                if rest:
                    text = mixture.cut_words(r[1], rest)
                    assert count(text) == rest and r[1].startswith(text)
                    want.append((r[0], text, s, len(text)))
            start += n
    got = P.mix_sources(spark, docs, sf).collect()
    assert bag((r.doc_id, r.text, r.source, r.n_chars) for r in got) == bag(want)
    assert bag(got) == bag(P.mix_sources(spark, docs.repartition(5, "lang"), sf).collect())


def test_encoding(spark, corpus):
    import sentencepiece

    docs, sf = corpus
    with open(pieces.default_model(), "rb") as f:
        sp = sentencepiece.SentencePieceProcessor(model_proto=f.read())

    def text(ids):
        raw = b"".join(bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids)
        return raw.decode()[1:]

    got = P.encode(spark, docs, sf).collect()
    assert bag((r.doc_id, text(r.ids)) for r in got) == bag((r[0], r[1] or "") for r in rows(docs))
    by = {}
    for r in got:  # equal rows, equal ids
        assert by.setdefault((r.doc_id, text(r.ids)), list(r.ids)) == list(r.ids)
