"""Language identification by error-correcting output codes.

Each language has a codeword; each bit of the code is a binary classifier over byte trigrams that says
whether a text's language has that bit set. Decoding takes, for each language, the sum over bits of
weight * logistic loss of the bit's margin against the codeword, and the nearest codeword wins. A bit's
weight is how far its margins stay from zero on the languages it was learned from. A text is ambiguous
if the runner-up comes within `AMBIGUOUS` of the winner's probability.

All labelled training rows are counted; at most DIMENSIONS counts a language reach the driver, no text, and
languages are taken one at a time, so any number of them will do.

Edge cases: a text that is null or has no letter is `und` with score 0; with no training rows every text
is `und`; with one language every text with a letter gets it. Rows with null lang teach nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import chunks, map_arrow, read, text_bytes

DIMENSIONS = 1 << 15
AMBIGUOUS = 0.2
SMOOTHING = 0.5
SCORE_BYTES = 1 << 20

# letters fold to lower case, other ASCII to a blank, bytes of non-ASCII characters stay
_FOLD = np.array([b if b >= 128 else b | 32 if chr(b).isalpha() else 32 for b in range(256)], np.uint8)
_ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of all rows end to end, and their offsets. Runs of blanks are one blank."""
    folded = _FOLD[data]
    first = np.zeros(len(folded), bool)
    first[offsets[:-1][offsets[:-1] < len(folded)]] = True
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32) | first[1:]
    where = np.concatenate([[0], np.cumsum(keep)])[offsets]
    folded = folded[keep].astype(np.uint32)
    if len(folded) < 3:
        return np.zeros(0, np.int64), np.zeros_like(offsets)
    code = (folded[:-2] << np.uint32(16)) | (folded[1:-1] << np.uint32(8)) | folded[2:]
    hashed = ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
    inside = np.ones(len(hashed), bool)  # trigrams that run into the next row go
    for back in (1, 2):
        at = where[1:] - back
        inside[at[(at >= 0) & (at < len(hashed))]] = False
    # rows of under three bytes have none: their stretch lies wholly within what went
    count = np.concatenate([[0], np.cumsum(inside)])
    return hashed[inside], count[np.minimum(where, len(hashed))]


def codebook(n: int) -> np.ndarray:
    """Codewords of n languages as rows of -1 and 1: exhaustive up to 6, else the best of 100 random ones."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        columns = [[1] + [1 if (b >> i) & 1 else -1 for i in range(n - 1)] for b in range(2 ** (n - 1) - 1)]
        return np.array(columns).T
    best, apart = None, -1
    for seed in range(100):
        code = np.random.default_rng(seed).choice([-1, 1], size=(n, 15 * int(np.ceil(np.log2(n)))))
        distances = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * code.shape[1]
        varied = (abs(code.sum(axis=0)) < n).all()
        if varied and distances.min() > apart:
            best, apart = code, distances.min()
    return best


class LanguageModel:
    """Languages, codewords, and for each bit its trigram weights and its weight in decoding."""

    def __init__(self, languages: list[str], counts: Callable[[int], np.ndarray]):
        """counts(i): of each trigram in the texts of language i."""
        self.languages, self.code = languages, codebook(len(languages))
        if not languages:
            return

        def share(i: int) -> np.ndarray:
            p = counts(i) + SMOOTHING
            return p / p.sum()

        yes, no = np.zeros((2, self.code.shape[1], DIMENSIONS))
        for i, bits in enumerate(self.code):
            p = share(i)
            yes[bits > 0] += p
            no[bits < 0] += p
        self.weights = np.zeros_like(yes)
        if len(languages) > 1:
            on = (self.code > 0).sum(axis=0)[:, None]
            self.weights = np.log(yes / on) - np.log(no / (len(languages) - on))
        # expected margin a trigram, by language and bit
        margins = np.stack([self.weights @ share(i) * bits for i, bits in enumerate(self.code)])
        self.trust = np.maximum(margins.min(axis=0), 1e-3)
        self.trust /= self.trust.max()
        self.scale = 1 / np.maximum(np.abs(margins).mean(axis=0), 1e-3)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, probability, ambiguity of each row."""
        hashed, where = trigrams(data, offsets)
        n = np.maximum(np.diff(where), 1)
        margins = np.empty((len(n), len(self.weights)))
        for b, w in enumerate(self.weights):
            sums = np.concatenate([[0], np.cumsum(w[hashed])])
            margins[:, b] = (sums[where[1:]] - sums[where[:-1]]) / n * self.scale[b]
        sure = 2 * np.minimum(1, np.sqrt(n / 20))[:, None]  # few trigrams say less
        loss = np.stack([(self.trust * np.log1p(np.exp(-sure * margins * c))).sum(axis=1) for c in self.code], axis=1)
        p = np.exp(-(loss - loss.min(axis=1, keepdims=True)) * 4 / np.sqrt(len(self.weights)))
        p /= p.sum(axis=1, keepdims=True)
        order = np.sort(p, axis=1)
        near = order[:, -1] - order[:, -2] < AMBIGUOUS if p.shape[1] > 1 else np.zeros(len(p), bool)
        return p.argmax(axis=1), p.max(axis=1), near


def has_letter(data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
    ascii_ = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data])])
    out = ascii_[offsets[1:]] > ascii_[offsets[:-1]]
    wide = np.concatenate([[0], np.cumsum(data >= 128)])
    for i in np.flatnonzero(~out & (wide[offsets[1:]] > wide[offsets[:-1]])):
        out[i] = any(c.isalpha() for c in texts[int(i)].as_py())
    return out


def learn(training: DataFrame) -> LanguageModel:
    """From text and lang of all given rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in chunks(batches, "text"):
            data, offsets = text_bytes(b.column("text"))
            hashed, where = trigrams(data, offsets)
            langs = b.column("lang").to_pylist()
            owner = np.repeat(np.arange(len(langs)), np.diff(where))
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])[owner]
            got = np.bincount(code * DIMENSIONS + hashed, minlength=len(names) * DIMENSIONS).reshape(-1, DIMENSIONS)
            for name, row in zip(names, got):
                counts[name] = counts.get(name, 0) + row
        for name, row in counts.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at].astype(np.int64))], ["lang", "feature", "n"])

    rows = training.where("lang is not null and text is not null").select("lang", "text")
    got = map_arrow(rows, count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(got["lang"].unique())
    own = {lang: (g["feature"].to_numpy(int), g["n"].to_numpy(float)) for lang, g in got.groupby("lang")}

    def counts(i: int) -> np.ndarray:
        out = np.zeros(DIMENSIONS)
        out[own[languages[i]][0]] = own[languages[i]][1]
        return out

    return LanguageModel(languages, counts)


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, held_out (empty here), lang_pred, score, ambiguous of every row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text", SCORE_BYTES):
            ids = b.column("doc_id").cast(pa.int64())
            data, offsets = text_bytes(b.column("text"))
            if model.languages:
                best, p, near = model.predict(data, offsets)
                known = has_letter(data, offsets, b.column("text"))
            else:
                best, p, near, known = np.zeros(len(ids), int), np.zeros(len(ids)), np.zeros(len(ids), bool), np.zeros(len(ids), bool)
            held = [zlib.crc32(str(i).encode()) % 3 == 1 if i is not None else False for i in ids.to_pylist()]
            langs = [model.languages[k] if ok else "und" for k, ok in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([ids, pa.array(held), pa.array(langs, pa.string()), pa.array(np.where(known, p, 0.0)), pa.array(near & known)], [c.split()[0] for c in SCHEMA.split(", ")])

    return map_arrow(docs.select("doc_id", "text"), predict, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = learn(docs.where("crc32(cast(doc_id as string)) % 3 != 1"))
    return identify(docs, model)
