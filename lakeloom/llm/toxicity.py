"""Toxicity: a classifier that is regularised by counterfactual identity terms.

Features are the presence of words and of word starts, chosen by how much they tell about the label on a
bounded sample of labelled texts. In each sentence of theirs that names a group, the identity term is
swapped for each other term of its kind; training adds `penalty` times the squared change of the sentence's
logit, so a group's mention alone moves no score. Kinds of terms are a parameter, also as a table (kinds_of).

Scores come from the text alone. Learning uses at most MAX_TRAIN labelled rows (those first by a hash of
doc_id, toxic ones and others alike); their features that tell enough reach the driver, and their swaps
that differ, with counts.

Edge cases: null and empty texts get the score of a text with no known feature; labels other than 0 and 1
teach nothing, nor do null ones; with one class or no labels at all every score is the smoothed share of the label; repeated
rows are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import chunks, map_arrow, read, schema_of

MAX_TRAIN = 20_000
MIN_ROWS = 4
MIN_G2 = 12.0
PENALTY = 1.0
RIDGE = 0.1
STARTS = (3, 4, 5, 6, 7)  # letters of word starts: a stem shows whatever its ending
#: Words whose features a worker remembers, and features it counts before it passes them on.
REMEMBERED = 500_000

#: Kinds of group; a term is swapped within its kind. A parameter of learn().
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "woman", "man", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "heterosexual", "homosexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives", "migrants", "locals"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def word_features(word: str) -> list[str]:
    """A word, and its starts (with a trailing *)."""
    return [word] + [word[:n] + "*" for n in STARTS if n < len(word)]


def features(text: str | None) -> set[str]:
    """Words of a text and their starts."""
    return {f for w in words(text) for f in word_features(w)}


class ToxicityModel:
    def __init__(self, names: list[str], weights: np.ndarray, bias: float):
        self.bias = bias
        self.value = dict(zip(names, weights.tolist()))
        self.known: dict[str, tuple] = {}

    def score(self, text: str | None) -> float:
        value, known, found = self.value, self.known, set()
        if len(known) > REMEMBERED:
            known.clear()
        for w in words(text):
            got = known.get(w)
            if got is None:
                got = known[w] = tuple(f for f in word_features(w) if f in value)
            if got:
                found.update(got)
        z = self.bias + sum(value[f] for f in sorted(found))
        return 1 / (1 + math.exp(-min(max(z, -60.0), 60.0)))


def kinds_of(terms: DataFrame) -> tuple[tuple[str, ...], ...]:
    """Kinds of identity terms from a table (kind, term); null terms are left out."""
    rows = terms.where("term is not null").select("kind", F.lower("term").alias("term")).distinct().collect()
    return tuple(tuple(sorted(r.term for r in rows if r.kind == k)) for k in sorted({r.kind for r in rows}, key=str))


def swaps(text: str | None, kinds) -> Iterator[tuple[frozenset[str], frozenset[str]]]:
    """For each identity term of each sentence and each other term of its kind: features that a swap takes and adds."""
    for sentence in _SENTENCE.findall(text or ""):
        own = words(sentence)
        for kind in kinds:
            for term in own.intersection(kind):
                rest = {f for w in own - {term} for f in word_features(w)}
                for other in kind:
                    if other not in own:
                        a, b = set(word_features(term)) - rest, set(word_features(other)) - rest
                        yield frozenset(a - b), frozenset(b - a)


def swap_gap(model: ToxicityModel, texts: list[str], kinds) -> float:
    """The mean change of the score when a sentence's identity term is swapped, in plain terms."""
    changes = []
    for sentence in (s for t in texts for s in _SENTENCE.findall(t or "")):
        own = words(sentence)
        for kind in kinds:
            for term in own.intersection(kind):
                swapped = [re.sub(rf"(?i)\b{term}\b", other, sentence) for other in kind if other not in own]
                changes += [abs(model.score(sentence) - model.score(s)) for s in swapped]
    return sum(changes) / len(changes) if changes else 0.0


def fit(rows: list[tuple[list[int], int]], n: int, pairs: list[tuple[list[int], list[int], int]], penalty: float = PENALTY, ridge: float = RIDGE, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on presence features; pairs: features that a swap takes and adds, and how often."""
    y = np.array([label for _, label in rows], float)
    at = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    col = np.array([f for fs, _ in rows for f in fs], np.int64)
    pair_at = np.array([i for i, (a, b, _) in enumerate(pairs) for _ in a + b], np.int64)
    pair_col = np.array([f for a, b, _ in pairs for f in a + b], np.int64)
    sign = np.array([s for a, b, _ in pairs for s in [1.0] * len(a) + [-1.0] * len(b)])
    often = np.array([c for _, _, c in pairs], float)
    share = (y.sum() + 1) / (len(y) + 2)
    weight = np.where(y > 0, np.sqrt(max(1.0, (len(y) - y.sum()) / max(y.sum(), 1))), 1.0)  # a rare label counts more
    w, bias = np.zeros(n), float(np.log(share / (1 - share)))
    m = np.zeros(n + 1)
    s = np.zeros(n + 1)
    for step in range(1, steps + 1):  # Adam on the whole sample
        z = bias + np.bincount(at, weights=w[col], minlength=len(y))
        error = (1 / (1 + np.exp(-z)) - y) * weight
        g = np.bincount(col, weights=error[at], minlength=n) + ridge * w
        if len(pairs):
            change = np.bincount(pair_at, weights=sign * w[pair_col], minlength=len(pairs)) * often
            g += penalty * np.bincount(pair_col, weights=sign * change[pair_at], minlength=n)
        g = np.append(g, error.sum())
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w, float(bias)


def learn(docs: DataFrame, labels: DataFrame, kinds=IDENTITY_TERMS, max_train: int = MAX_TRAIN, penalty: float = PENALTY) -> ToxicityModel:
    """From the texts of docs (doc_id, text) that labels (doc_id, label) knows; labels but 0 and 1 are left out.

    The sample is chosen among the labels, so what is sent to find its texts is bounded by max_train rows.
    """
    chosen = labels.where("label in (0, 1) and doc_id is not null").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_train)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label").cache()
    try:
        totals = {r.label: r.n for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
        yes, no = totals.get(1, 0), totals.get(0, 0)
        if not yes or not no:
            share = (yes + 1) / (yes + no + 2)
            return ToxicityModel([], np.zeros(0), float(np.log(share / (1 - share))))

        def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = (Counter(), Counter())
            for b in batches:
                for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                    seen[label].update(features(text))
                if len(seen[0]) + len(seen[1]) > REMEMBERED:
                    yield from _counted(seen)
            yield from _counted(seen)

        a, b = F.sum(F.col("label") * F.col("n")).cast("double").alias("a"), F.sum((1 - F.col("label")) * F.col("n")).cast("double").alias("b")
        stats = map_arrow(sample.dropDuplicates(["text", "label"]), found, "feature string, label int, n long").groupBy("feature").agg(a, b).where(f"a + b >= {MIN_ROWS}")

        def part(seen, of):  # a term of the G statistic
            return F.when(seen > 0, seen * F.log(seen / of)).otherwise(0.0)

        rate = (F.col("a") + F.col("b")) / (yes + no)
        g2 = 2 * (part(F.col("a"), yes * rate) + part(F.col("b"), no * rate) + part(yes - F.col("a"), yes * (1 - rate)) + part(no - F.col("b"), no * (1 - rate)))
        # the sample may hold copies, which the counts leave out; a share over 1 can't be
        chosen = stats.where(rate < 1).withColumn("g2", g2).where(F.col("g2") >= MIN_G2)
        names = sorted({r.feature for r in chosen.select("feature").collect()} | {f for kind in kinds for t in kind for f in features(t)})
        index = {f: i for i, f in enumerate(names)}

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = [sorted(index[f] for f in features(text) & index.keys()) for text in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32())), b.column("label")], ["own", "label"])

        def swapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter = Counter()
            for b in batches:
                for text in b.column("text").to_pylist():
                    seen.update((tuple(sorted(index[f] for f in x)), tuple(sorted(index[f] for f in y))) for x, y in swaps(text, kinds))
            found = list(seen)
            lists = [pa.array([list(p[k]) for p in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([seen[p] for p in found], pa.int64())], ["takes", "adds", "n"])

        got = map_arrow(sample.orderBy("doc_id", "label"), project, "own array<int>, label int").collect()
        found = map_arrow(sample, swapped, "takes array<int>, adds array<int>, n long").groupBy("takes", "adds").agg(F.sum("n").alias("n")).orderBy("takes", "adds").collect()
        pairs = [(list(r.takes), list(r.adds), r.n) for r in found]
        weights, bias = fit([(list(r.own), r.label) for r in got], len(names), pairs, penalty)
        keep = np.abs(weights) > 1e-3
        return ToxicityModel([n for n, k in zip(names, keep) if k], weights[keep], bias)
    finally:
        sample.unpersist()


def _counted(seen: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
    for label, counts in enumerate(seen):
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([label] * len(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())], ["feature", "label", "n"])
        counts.clear()


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            ids = b.column("doc_id").cast(pa.int64())
            scores = [float(model.score(t)) for t in b.column("text").to_pylist()]
            held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 0 for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([ids, pa.array(held), pa.array(scores), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)


def keep_clean(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows, in their own columns, whose score is under 0.5."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            yield b.filter(pa.array([model.score(t) < 0.5 for t in b.column("text").to_pylist()], pa.bool_()))

    return map_arrow(docs, run, schema_of(docs))


def learn_from(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> ToxicityModel:
    docs = docs if docs is not None else read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", F.col("toxic").alias("label"))
    return learn(docs, labels.where("crc32(cast(doc_id as string)) % 5 != 0"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents", "doc_id", "text"), learn_from(spark, sf_dir))
