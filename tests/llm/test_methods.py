"""The methods themselves: distributions, codes, decoders, brute force on the small tables."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from lakeloom.llm import language_id, media, mixture, ngram_jaccard, pieces, registry, repeats, spotsigs, toxicity
from lakeloom.llm.common import Scratch, text_bytes
from lakeloom.llm.components import components


@pytest.fixture(scope="module")
def documents(sf):
    return pd.read_parquet(f"{sf}/documents.parquet")


def rows(table):
    columns = sorted(table.column_names)
    return columns, sorted((tuple(r[c] for c in columns) for r in table.to_pylist()), key=repr)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert rows(registry.QUERIES[name](spark, sf).toArrow()) == rows(c.sql(registry.SQL[name]).to_arrow_table())


def test_names():
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


# --- 1


def test_sampled_segmentations_have_their_probabilities():
    lattices = pieces.lattices(open(pieces.default_model(), "rb").read(), 1.0)
    v, n, word = lattices.vocabulary, 40_000, "thering"
    flat, edges = lattices.sample([word] * n, list(range(n)), 3)
    got = Counter(tuple(flat[a:b].tolist()) for a, b in zip(edges, edges[1:]))
    known = {bytes(v.raw[i].as_py()): i for i in range(259, len(v.raw))}
    chances = {}

    def split(rest, ids, log):
        if not rest:
            chances[tuple(ids)] = math.exp(log)
        for k in range(1, len(rest) + 1):
            if (i := known.get(rest[:k])) is not None:
                split(rest[k:], [*ids, i], log + v.log_weight[i])

    split((" " + word).encode(), [], 0.0)
    total = sum(chances.values())
    assert set(got) <= set(chances)
    assert max(abs(got[s] / n - p / total) for s, p in chances.items()) < 0.01


def test_encoding_is_lossless_and_repeatable(spark, sf, documents):
    a = pieces.query(spark, sf).toPandas().sort_values("doc_id")
    b = pieces.encode(spark.read.parquet(f"{sf}/documents.parquet").repartition(7)).toPandas().sort_values("doc_id")
    assert a.lossless.all() and [list(x) for x in a.ids] == [list(x) for x in b.ids]
    texts = pieces.decode(spark.createDataFrame(a[["doc_id", "ids"]].values.tolist(), "doc_id long, ids array<int>")).toPandas().sort_values("doc_id")
    assert texts.text.tolist() == documents.sort_values("doc_id").text.tolist()


def test_lattices_follow_beginnings_of_pieces_alone(monkeypatch):
    """Strings that begin no piece aren't made longer; bytes decode to the text still, and short groups give the same ids."""
    vocabulary = pieces.Vocabulary(open(pieces.default_model(), "rb").read())
    texts = ["qzxjqzxjqzxjqzxjqzxj", "the thing 漢字 of it", "\ud7ff▁\n\n x   y"]
    asked, extend = [], pieces.extend
    monkeypatch.setattr(pieces, "extend", lambda keys, chars: asked.append(keys.size) or extend(keys, chars))
    flat, edges = pieces.Lattices(vocabulary).sample(texts, [1, 2, 3], 5)
    n = sum(len(w) for t in texts for w in set(pieces._SEGMENT.findall(" " + t)))
    assert sum(asked) < 6 * n
    ids = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat))
    assert [t.decode() for t in vocabulary.decode(ids)] == texts
    alone = [pieces.Lattices(vocabulary).sample([t], [k], 5)[0].tolist() for k, t in enumerate(texts, 1)]
    assert ids.to_pylist() == alone


def test_beginnings_in_common_are_one_lattice(monkeypatch):
    """Words that begin alike share places; the places that cut texts into words, and long words, give what words alone give."""
    vocabulary = pieces.Vocabulary(open(pieces.default_model(), "rb").read())
    lattices = pieces.Lattices(vocabulary)
    word = "internationalisation"
    lattices.add([f" {word}{c}" for c in "abcdefghijklmnopqrstuvwxyz"])
    alone = pieces.Lattices(vocabulary)
    alone.add([f" {word}a"])
    assert lattices.edges < 3 * alone.edges
    texts = [None, "", " ", "\n", "a\n\n b  c \n", "  x", "é 漢  字\r\n y\t", "end ", "the thing"]
    words, counts = pieces.segments(pa.array(texts))
    assert words.to_pylist() == [w for t in texts if t for w in pieces._SEGMENT.findall(" " + t)]
    assert counts.tolist() == [len(pieces._SEGMENT.findall(" " + t)) if t else 0 for t in texts]
    assert len(pieces.segments(pa.array([None, ""], pa.string()))[0]) == 0
    rows = ["internationally the internal things", "the thing 漢字of it" * 9]
    flat, edges = lattices.sample(rows, [1, 2], 5)
    for name, limit in (("LONG", 3), ("ADDED_CHARS", 1)):
        monkeypatch.setattr(pieces, name, limit)
        again, at = pieces.Lattices(vocabulary).sample(rows, [1, 2], 5)
        assert again.tolist() == flat.tolist() and at.tolist() == edges.tolist()


def test_scratch_tables_have_no_marker(spark, tmp_path, monkeypatch):
    scratch = Scratch(spark, "marker")
    monkeypatch.setattr(scratch, "base", f"file://{tmp_path}/scratch")
    assert scratch.save(spark.range(5), "numbers").count() == 5
    assert not list(tmp_path.rglob("*_SUCCESS*")) and list(tmp_path.rglob("part-*.parquet"))


# --- 2


def test_swapped_identity_terms_score_alike(spark):
    random.seed(1)
    fill = "we saw them in town today and all was fine".split()
    docs, labels = [], []
    for i in range(400):
        toxic = i % 2
        group = "muslims" if random.random() < (0.8 if toxic else 0.2) else "christians"
        docs.append((i, " ".join(random.sample(fill, 6) + [group] + (["scum"] if toxic and random.random() < 0.9 else []))))
        labels.append((i, toxic))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int")
    gap = {}
    for penalty in (0.0, 10.0):
        model = toxicity.learn(d, lab, penalty=penalty)
        gap[penalty] = abs(model.score("we saw muslims today") - model.score("we saw christians today"))
        assert model.score("scum in town") > 0.5 > model.score("all was fine in town")
    assert gap[10.0] < 0.3 * gap[0.0]


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.query(spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    held = got[got.held_out]
    assert (held.held_out == held.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert held[held.toxic == 1].predicted.mean() > 0.85 and held[held.toxic == 0].predicted.mean() < 0.01


def test_swaps_are_within_sentences():
    kinds = (("men", "women"),)
    got = list(toxicity.swaps("The men ran. We saw nothing! Women and men rest\nmen sleep", kinds))
    takes, adds = set(toxicity.word_features("men")), set(toxicity.word_features("women"))
    assert got == [(frozenset(takes), frozenset(adds))] * 2  # not where both are named
    assert list(toxicity.swaps(None, kinds)) == []


def test_penalty_spares_neutral_mentions(spark):
    """False positives on neutral sentences that name the group the toxic texts name, with and without the penalty."""
    random.seed(4)
    fill = "we saw them in town today and all was fine with our friends at work".split()
    docs = [(i, " ".join(random.sample(fill, 6) + (["refugees"] if i % 2 else ["locals"] if i % 8 == 0 else []) + (["vermin"] if i % 2 and random.random() < 0.9 else [])) + ". " + " ".join(random.sample(fill, 6))) for i in range(400)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(3, 7), (4, -1), (5, None)], "doc_id long, label int")
    table = spark.createDataFrame([("origin", "Refugees"), ("origin", "locals"), ("origin", None)], "kind string, term string")
    kinds = toxicity.kinds_of(table)
    assert kinds == (("locals", "refugees"),)
    neutral = [" ".join(random.sample(fill, 6) + ["refugees"]) for _ in range(50)]
    wrong, gap = {}, {}
    for penalty in (0.0, 20.0):
        model = toxicity.learn(d, lab, kinds=kinds, penalty=penalty)
        wrong[penalty] = sum(model.score(t) >= 0.5 for t in neutral) / len(neutral)
        gap[penalty] = toxicity.swap_gap(model, neutral, kinds)
    print(wrong, gap)
    assert wrong[20.0] < wrong[0.0] and gap[20.0] < gap[0.0] / 2


# --- 3


def test_maximal_repeats_by_brute_force():
    random.seed(0)
    for _ in range(20):
        strings = [bytes(random.choice(b"ab") for _ in range(random.randint(0, 30))) for _ in range(6)]
        data, ends = np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(s) for s in strings])
        starts, raw = ends - np.array([len(s) for s in strings]), data.tobytes()
        place, length, lo, hi = repeats.maximal_repeats(data, starts, ends, 4)
        got = {(raw[place[a] : place[a] + n], tuple(sorted(place[a : b + 1].tolist()))) for n, a, b in zip(length, lo, hi)}
        seen = {}
        for x, e in zip(starts, ends):
            for i in range(x, e):
                for j in range(i + 4, e + 1):
                    seen.setdefault(raw[i:j], []).append((i, x, e))
        want = set()
        for w, at in seen.items():
            before = {raw[i - 1] if i > x else -i - 1 for i, x, _ in at}
            after = {raw[i + len(w)] if i + len(w) < e else -i - 1 for i, _, e in at}
            if len(at) > 1 and len(before) > 1 and len(after) > 1:
                want.add((w, tuple(sorted(i for i, _, _ in at))))
        assert got == want


@pytest.mark.parametrize("most", [repeats.MAX_RUNS, 2])
def test_repeated_bytes_by_brute_force(spark, sf, documents, most):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in repeats.cut_repeats(repeats.read(spark, sf, "documents", "doc_id", "text"), most=most).collect()}
    want = repeats.brute_force([(d, t, 0) for d, t in zip(documents.doc_id, documents.text)])
    assert got == {d: v for (d, _), v in want.items()}


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_sharing_in_batches(size, monkeypatch):
    """Whatever the batches: runs whose anchor has another, told apart by whether it has more than three."""
    monkeypatch.setattr(repeats, "DEALT_ROWS", 1)
    random.seed(size)
    runs = sorted((random.choice([0, 1, 1, 1, 1, 2, 2, 3, 4, 5, 6, 7]), k, 5, repeats.pack(0, random.randrange(30), 1, 0, int(k % 5 == 0))) for k in range(24))
    table = pa.table([pa.array(x, pa.int64()) for x in zip(*runs)], names=["h", "id", "v", "packed"])
    got = [tuple(r.values()) for b in repeats._share(3)(iter(table.to_batches(max_chunksize=size))) for r in b.to_pylist()]
    open_ = [r for r in runs if not r[3] & 1]
    count = {h: sum(r[0] == h for r in open_) for h, *_ in runs}
    want = [(0, *r) for r in runs if r[3] & 1] + [(2 if count[r[0]] > 3 else 1, *r) for r in open_ if count[r[0]] > 1]
    assert sorted(got) == sorted(want)


def test_equal_hashes_settle_nothing(monkeypatch):
    """Runs of one content hash but other bytes both stay."""
    monkeypatch.setattr(repeats, "mix64", lambda x: np.zeros_like(x.astype(np.uint64)))
    texts = ["a" * 100, "b" * 100, "a" * 100]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3], pa.int64()), pa.array(texts), pa.array([1, 2, 3], pa.int64())], ["doc_id", "text", "v"])
    got = pa.Table.from_batches(repeats._deal(iter([batch]))).to_pylist()
    assert {r["id"] for r in got if r["packed"] & 1} == {3}


@pytest.mark.parametrize("size", [0, 31, 99, 100, 101, 1000])
def test_runs_hashed_in_parts(size, monkeypatch):
    """Anchors and runs as if all were hashed at once, and never more than a part at once."""
    random.seed(size)
    texts = ["".join(random.choices("ab", k=size)), "", "x" * size, "".join(random.choices("ab", k=150)), ""]
    data, offsets = text_bytes(pa.array(texts))
    whole = repeats.runs(data, offsets)
    h = repeats.gram_hashes(data)
    span = repeats.WIDTH - repeats.K + 1
    assert repeats.anchors(h, span).tolist() == [min(range(i, i + span), key=lambda j: (int(h[j]) >> 32, j)) for i in range(len(h) - span + 1)]
    monkeypatch.setattr(repeats, "HASHED_BYTES", 64)
    most, mix64 = [], repeats.mix64
    monkeypatch.setattr(repeats, "mix64", lambda x: most.append(len(x)) or mix64(x))
    assert repeats.gram_hashes(data).tolist() == h.tolist() and max(most) < 64 + repeats.K
    monkeypatch.undo()
    monkeypatch.setattr(repeats, "HASHED_BYTES", 64)
    assert all((a == b).all() for a, b in zip(repeats.runs(data, offsets), whole))
    windows = [(i, k) for i, t in enumerate(texts) for k in range(len(t) - repeats.WIDTH + 1)]
    row, start, more = whole[:3]
    assert [(r, k) for r, s, m in zip(row.tolist(), start.tolist(), more.tolist()) for k in range(s, s + m + 1)] == windows


# --- 4


def test_water_filling():
    assert mixture.water_fill([10, 10, 10], [1, 2, 3]) == [5.0, 10.0, 15.0]
    assert mixture.water_fill([100, 1, 1], [1, 2, 3]) == [96.0, 3.0, 3.0]
    assert mixture.water_fill([0, 5], [1, 1]) == [0.0, 5.0]
    assert mixture.water_fill([], []) == []


def test_schedule_is_even(spark):
    got = mixture.schedule(spark, [60.0, 30.0, 10.0], 100_000).toPandas()
    assert sorted(got.slot) == list(range(100_000))
    for _, own in got.sort_values("slot").groupby("src"):
        assert own["rank"].tolist() == list(range(len(own)))
    for n in (100, 5_000, 50_000, 100_000):  # every stretch of the mix is near its shares
        first = got[got.slot < n].src.value_counts()
        assert all(abs(first[j] - n * w) <= 4 for j, w in enumerate((0.6, 0.3, 0.1)))


# --- 6


def test_codebooks():
    for n in (2, 4, 6, 12):
        code = language_id.codebook(n)
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert apart >= (1 if n == 2 else code.shape[1] // 3) and (abs(code.sum(axis=0)) < n).all()


def test_languages_of_held_out_rows(spark, documents):
    sf = "/root/testdata/sf0.01"
    got = language_id.query(spark, sf).toPandas().merge(pd.read_parquet(f"{sf}/documents.parquet"), on="doc_id")
    held = got[got.held_out]
    assert len(held) > 200 and (held.lang_pred == held.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_decoding_by_brute_force(spark, documents):
    """Trigrams, bit margins and loss-weighted decoding in plain Python, for the languages of the table and for many."""
    few = documents.head(60)

    def grams(text):
        out, folded = [], bytearray()
        for b in text.encode():
            c = b if b >= 128 else b | 32 if chr(b).isalpha() else 32
            if c != 32 or not folded or folded[-1] != 32:
                folded.append(c)
        for k in range(len(folded) - 2):
            code = folded[k] << 16 | folded[k + 1] << 8 | folded[k + 2]
            out.append((code * 2654435761 & 0xFFFFFFFF) >> 17)
        return out

    for langs in (few.lang.tolist(), [f"l{k % 30}" for k in range(60)]):
        train = [(t, x) for t, x in zip(few.text, langs)]
        frame = spark.createDataFrame(train, "text string, lang string")
        model = language_id.learn(frame)
        names = sorted(set(langs) - {None})
        counts = {x: Counter() for x in names}
        for t, x in train:
            if x is not None:
                counts[x].update(grams(t or ""))
        size = language_id.DIMENSIONS
        share = {x: lambda g, c=counts[x]: (c[g] + language_id.SMOOTHING) / (sum(c.values()) + language_id.SMOOTHING * size) for x in names}
        assert model.languages == names
        for text in ["the house is big", few.text.iloc[0][:300], few.text.iloc[7][:80]]:
            own = grams(text)
            loss = {}
            for k, x in enumerate(names):
                loss[x] = 0.0
                for b in range(model.code.shape[1]):
                    yes = [n for j, n in enumerate(names) if model.code[j, b] > 0]
                    no = [n for n in names if n not in yes]
                    weight = {g: math.log(sum(share[n](g) for n in yes) / len(yes)) - math.log(sum(share[n](g) for n in no) / len(no)) for g in set(own)}
                    margin = sum(weight[g] for g in own) / max(len(own), 1) * model.scale[b]
                    sure = 2 * min(1, math.sqrt(max(len(own), 1) / 20))
                    loss[x] += model.trust[b] * math.log1p(math.exp(-sure * margin * model.code[k, b]))
            p = {x: math.exp(-(v - min(loss.values())) * 4 / math.sqrt(model.code.shape[1])) for x, v in loss.items()}
            data = np.frombuffer(text.encode(), np.uint8)
            best, score, _ = model.predict(data, np.array([0, len(data)]))
            assert names[best[0]] == max(p, key=p.get) and abs(score[0] - max(p.values()) / sum(p.values())) < 1e-9


# --- 7


def bits(pairs):
    out = "".join(format(v, f"0{n}b") for v, n in pairs if n)
    out += "1" * (-len(out) % 8)
    return bytes(int(out[i : i + 8], 2) for i in range(0, len(out), 8)).replace(b"\xff", b"\xff\0")


def test_reader_of_other_jpegs():
    """Two components, 2x1 sampling, AC coefficients, no restarts, a quantiser of 16."""
    dc = {s: (c, n) for s, c, n in media.canonical(media.DC_COUNTS, media.DC_SYMBOLS)}
    ac_counts, ac_symbols = [0, 2, 1] + [0] * 13, [0x00, 0x01, 0xF0]
    ac = {s: (c, n) for s, c, n in media.canonical(ac_counts, ac_symbols)}

    def value(d):
        n = abs(d).bit_length()
        return [dc[n], (d if d >= 0 else d + (1 << n) - 1, n)]

    luma, chroma, stream, last = [[3, -7], [10, 0]], [5, -2], [], [0, 0]
    for m in range(2):  # MCUs: two luma blocks, one chroma block
        for x in luma[m]:
            stream += [*value(x - last[0]), ac[0x01], (1, 1), ac[0xF0], ac[0x00]]
            last[0] = x
        stream += [*value(chroma[m] - last[1]), ac[0x00]]
        last[1] = chroma[m]
    jpeg = b"\xff\xd8" + media._segment(0xE0, b"JFIF\0") + media._segment(0xDB, b"\0" + b"\x10" * 64)
    jpeg += media._segment(0xC0, struct.pack(">BHHB", 8, 8, 32, 2) + b"\x01\x21\x00\x02\x11\x00")
    jpeg += media._segment(0xC4, b"\x00" + bytes(media.DC_COUNTS) + bytes(media.DC_SYMBOLS) + b"\x10" + bytes(ac_counts) + bytes(ac_symbols))
    jpeg += media._segment(0xDA, b"\x02\x01\x00\x02\x00\x00\x3f\x00") + bits(stream) + b"\xff\xd9"
    frame = media.decode(jpeg)[0]
    assert (frame.width, frame.height) == (32, 8)
    assert media.thumbnails([frame])[0].tolist() == [[134, 114, 148, 128]]
    for bad in (jpeg[:-20], jpeg.replace(b"\xff\xc0", b"\xff\xc2"), b"GIF"):
        with pytest.raises(ValueError):
            media.thumbnails(media.decode(bad))


def test_media_round_trip():
    rng = np.random.default_rng(0)
    sizes = [0, 1, 575, 576, 577, media.FRAME, media.FRAME + 1, 3 * media.FRAME]
    data = [rng.integers(0, 256, n, dtype=np.uint8) for n in sizes]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    for raw, (back, _) in zip(data, media.read_back(media.store(np.concatenate(data), offsets))):
        n = max(1, -(-len(raw) // 576)) * 576
        assert back == raw.tobytes() + b"\xff" * (n - len(raw))


def test_media_query(spark, sf, documents):
    got = media.query(spark, sf).toPandas().merge(documents, on="doc_id")
    pay = [t.encode() + b"\xff" * (-len(t.encode()) % 576) for t in got.text]
    assert got.payload_sha256.tolist() == [hashlib.sha256(p).hexdigest() for p in pay]
    assert got.tail_crc32.tolist() == [zlib.crc32(p[-32:]) for p in pay]
    assert got.groupby("text").media_sha256.nunique().max() == 1


# --- 9


def signature_set(text):
    import re

    words = re.findall(r"[^\W_]+", text.lower())
    content, found, k = [w for w in words if w not in spotsigs.ANCHORS], set(), 0
    for w in words:
        if w in spotsigs.ANCHORS:
            if k + 2 <= len(content):
                found.add((w, content[k], content[k + 1]))
        else:
            k += 1
    return found or ({tuple(words)} if words else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_spotsigs_by_brute_force(spark, sf, documents):
    docs = documents.sort_values("doc_id")
    texts = docs.text.tolist()
    after = texts[1:] + texts[:1]
    spotsigs.RANGE_CHARS, before = 50_000, spotsigs.RANGE_CHARS  # several ranges
    try:
        got = spotsigs.query(spark, sf).toPandas().sort_values("doc_id")
    finally:
        spotsigs.RANGE_CHARS = before
    assert got.edited_sha256.tolist() == [spotsigs.edited_sha256(a, b) for a, b in zip(texts, after)]
    sets = [signature_set(t) for t in texts]
    edited = [signature_set(spotsigs.edited_text(a, b)) for a, b in zip(texts, after)]
    assert np.allclose(got.near_next, [jaccard(a, b) for a, b in zip(sets, sets[1:] + sets[:1])])
    assert np.allclose(got.near_edited, [jaccard(a, b) for a, b in zip(sets, edited)])


def test_near_fingerprints_by_brute_force(spark, documents, sf):
    got = spotsigs.query(spark, sf).toPandas()
    sets = {i: signature_set(t) for i, t in zip(documents.doc_id, documents.text)}
    near, same = {i: i for i in sets}, {i: i for i in sets}

    def root(of, x):
        return x if of[x] == x else root(of, of[x])

    ids = sorted(i for i in sets if sets[i])
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            for of, least in ((near, 0.8), (same, 1.0)):
                if jaccard(sets[a], sets[b]) >= least:
                    x, y = sorted((root(of, a), root(of, b)))
                    of[y] = x
    assert dict(zip(got.doc_id, got.near_id)) == {i: root(near, i) for i in sets}
    assert dict(zip(got.doc_id, got.class_id)) == {i: root(same, i) for i in sets}
    assert (got.near_id != got.class_id).any()


# --- 10


def test_components(spark):
    random.seed(3)
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    assert dict(map(tuple, got.collect())) == {x: root(x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("n, num, den", [(4, 85, 100), (2, 50, 100)])
def test_links_by_brute_force(spark, n, num, den):
    """A large group of near copies, groups that share a passage, chains of edits."""
    random.seed(5)
    word = lambda: random.choice(WORDS)
    base, passage, rows = [word() for _ in range(60)], [word() for _ in range(20)], []
    for i in range(60):
        w = list(base)
        for _ in range(random.randrange(5)):
            w[random.randrange(60)] = word()
        rows.append((len(rows), " ".join(w)))
    for i in range(40):
        rows.append((len(rows), " ".join([word() for _ in range(random.randrange(20))] + passage + [word() for _ in range(5)])))
    chain = list(base[:30])
    for i in range(30):
        chain[i] = word()
        rows.append((len(rows), " ".join(chain)))
    random.shuffle(rows)
    rows += [(500, None), (501, ""), (502, "one two"), (503, "ONE two"), (504, "one\ttwo three")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.link(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), n, num, den).collect()}
    assert got == ngram_jaccard.brute_force(rows, n, num, den)


def test_words_are_hashed_without_a_python_step_each():
    """Hashes from the bytes of all texts at once tell the same words apart as split and lower do."""
    random.seed(6)
    letters = ["a", "B", "b", "A", "\u00e9", "\u3000", "\x85", "\x1c", "\x00", "\u1e9e", *" \t\n\x0b\x0c\r"]
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(30))) for _ in range(2000)]
    texts += [None, "", "  ", *("x" * k for k in (7, 8, 9, 255, 256, 257)), "X" * 257, "y" * 5000 + " z"]
    hashes, counts = ngram_jaccard._word_hashes(*text_bytes(pa.array(texts, pa.string())))
    words = [(t or "").encode().lower().split() for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for ws in words for w in ws]
    assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist())))


WORDS = [f"w{i}" for i in range(400)]


def test_unlike_candidates_send_no_whole_sets(spark):
    """Fingerprints that share some rare signatures and little else meet in a bucket; their sketches tell them apart,
    so the sets that are fetched are those of near copies alone, and no near copy is lost."""
    rng = random.Random(9)
    draw = lambda n: [rng.randrange(1 << 32) for _ in range(n)]
    near, rows = [], []
    for i in range(40):
        base = draw(60)
        near.append((f"n{i}a", f"n{i}b"))
        rows += [(f"n{i}a", sorted(base)), (f"n{i}b", sorted(base[:-4] + draw(4)))]
    pool = draw(1000)
    unlike = [(f"u{i}", sorted(rng.sample(pool, 50))) for i in range(60)]
    sets = spark.createDataFrame([(k.encode(), s) for k, s in rows + unlike], "k binary, s array<long>")
    met, fetched = set(), set()

    class Seen(Scratch):
        def save(self, df, name, *by):
            out = super().save(df, name, *by)
            if name in ("star", "rest"):
                met.update(bytes(x).decode() for r in out.collect() for x in r)
            if name == "sets":
                fetched.update(bytes(r.k).decode() for r in out.select("k").collect())
            return out

    got = {bytes(r.k).decode(): bytes(r.near).decode() for r in spotsigs.near_groups(sets, Seen(spark, "test", shuffled=True)).collect()}
    assert got == {k: a for a, b in near for k in (a, b)}
    assert fetched == set(got) and len(met - fetched) > 30
