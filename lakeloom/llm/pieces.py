"""SentencePiece encoding by sampling, and decoding.

Encoding draws a segmentation of the text from the piece lattice by forward filtering and backward
sampling: forward sums of piece probabilities up to each character, then pieces drawn from the end with
probability forward[start] * p(piece) / forward[end]. Draws are counter-based hashes of (seed, row key,
word, step), so a row's ids depend on its key and text alone, not on batches, tasks or attempts.

Pieces come from a public model file and are never trained. The file is a BPE model, whose scores are
merge ranks; a piece of rank r gets the Zipf weight 1 / (r + ZIPF) ** alpha. Characters without a piece
become UTF-8 byte pieces, as does a literal U+2581, so decoding gives the very text back. One blank is
put before a text (the model's dummy prefix) and taken off when decoding.

No piece has a blank after another character or a line feed beside one, so the lattice falls apart at
those places, and words are sampled one by one. A forward sum depends on the characters before its place alone,
so words added together share the places of the beginnings they have in common; sums are remembered.

Edge cases: null and empty texts have no ids, and decode to ""; null ids to null; equal rows get equal ids; one
very long word is a lattice of its own; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.common import chunks, map_arrow, mix64, read, text_bytes

ALPHA = 1.0
ZIPF = 10.0
SEED = 11
ENCODE_BYTES = 1 << 20
#: Characters of a word that is a lattice of its own.
LONG = 400
#: Characters of words that are added at once.
ADDED_CHARS = 1_000_000
#: Lattice edges that a task remembers before it starts anew.
REMEMBERED_EDGES = 4_000_000

#: A word. `segments` finds the same places in bytes.
_SEGMENT = re.compile(r"\n| *[^ \n]+| +")
_SLOTS = 19  # bits of a slot in the table of beginnings
_PRIME = np.uint64(0x100000001B3)
_NO_PIECE = -(2**31)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Vocabulary:
    """Pieces of a model file, their weights, and the table that finds them by hash."""

    def __init__(self, model: bytes, alpha: float = ALPHA):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.vocab_size()
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        text = {i: sp.id_to_piece(i).replace("▁", " ") for i in normal}
        if any(" " in p.lstrip(" ") or ("\n" in p and p != "\n") for p in text.values()):
            raise ValueError("a piece crosses a word's start or a line's end")
        self.byte_ids = np.full(256, -1, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(sp.id_to_piece(i)[1:-1], 16)] = i
        if (self.byte_ids < 0).any():
            raise ValueError("the model has no pieces for all bytes")
        order = sorted(normal, key=lambda i: (-sp.get_score(i), i))
        self.log_weight = np.zeros(n)
        self.log_weight[order] = -alpha * np.log(np.arange(len(order)) + ZIPF)
        self.floor = -alpha * np.log(len(order) + ZIPF)  # of a character's bytes
        raw = [b""] * n
        for i, p in text.items():
            raw[i] = p.encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            raw[i] = bytes([b])
        self.raw = pa.array(raw, pa.large_binary())
        # the beginnings of pieces by the hash of their keys: the piece that each is, or -1, and whether longer ones go on from it
        piece_of = {text[i]: i for i in reversed(normal)}
        inner = {p[:k] for p in piece_of for k in range(1, len(p))}
        self.bits = max(_SLOTS, (2 * len(inner | piece_of.keys())).bit_length())
        self.slot_key = np.zeros(1 << self.bits, np.uint64)
        self.slot_piece = np.full(1 << self.bits, _NO_PIECE, np.int32)  # of no beginning
        self.slot_inner = np.zeros(1 << self.bits, bool)
        for k in range(1, max(map(len, piece_of)) + 1):
            starts = sorted({p[:k] for p in piece_of if len(p) >= k})
            chars = np.frombuffer("".join(starts).encode("utf-32-le"), np.uint32).reshape(len(starts), k)
            keys = np.zeros(len(starts), np.uint64)
            for j in range(k):
                keys = extend(keys, chars[:, j].astype(np.uint64))
            for key, slot, p in zip(keys.tolist(), (keys >> np.uint64(64 - self.bits)).tolist(), starts):
                while self.slot_piece[slot] != _NO_PIECE:
                    if self.slot_key[slot] == key:
                        raise ValueError("two beginnings of pieces have one key")
                    slot = (slot + 1) & ((1 << self.bits) - 1)
                self.slot_key[slot], self.slot_piece[slot], self.slot_inner[slot] = key, piece_of.get(p, -1), p in inner

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slots of keys; those that aren't there get an empty one."""
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        more = np.flatnonzero((self.slot_key[slot] != keys) & (self.slot_piece[slot] != _NO_PIECE))
        while len(more):
            slot[more] = at = (slot[more] + 1) & ((1 << self.bits) - 1)
            more = more[(self.slot_key[at] != keys[more]) & (self.slot_piece[at] != _NO_PIECE)]
        return slot

    def decode(self, ids: pa.Array) -> list[bytes]:
        """The text, as UTF-8, of each list of ids; null: null."""
        lists = ids.cast(pa.large_list(pa.int32()))
        offsets = lists.offsets
        flat = lists.values
        joined = pc.binary_join(pa.LargeListArray.from_arrays(offsets, self.raw.take(flat)), pa.scalar(b"", pa.large_binary()))
        return [None if t is None else t[1:] for t in joined.to_pylist()]


def extend(keys: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Hash keys of strings that are one character longer."""
    return mix64((keys + chars + np.uint64(1)) * _PRIME)


def segments(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts end to end, each text with the dummy blank, and how many each has. Null: none."""
    texts = texts.cast(pa.large_string())
    blank = pc.if_else(pc.greater(pc.binary_length(texts), 0), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    data, offsets = text_bytes(pc.binary_join_element_wise(blank, texts, pa.scalar("", pa.large_string())))
    line, space = data == 10, data == 32
    begins = line.copy()
    begins[1:] |= line[:-1] | (space[1:] & ~space[:-1])
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
    return words, np.diff(np.searchsorted(starts, offsets))


class Lattices:
    """Forward-filtered lattices of words, in flat arrays that grow.

    A node is a place in the words added together that begin alike up to there, and is known by its first
    edge. Its edges, best first, have cumulative probabilities, the piece and the node they come from (-1:
    the place before all). A negative piece -1 - c stands for the bytes of character c.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self) -> None:
        self.ends: dict[str, int] = {}
        self.edges = 0
        self.source, self.piece, self.cumulative = (np.zeros(1 << 17, t) for t in (np.int32, np.int32, np.float64))

    def _grow(self, name: str, need: int) -> None:
        a = getattr(self, name)
        if need > len(a):
            setattr(self, name, np.concatenate([a, np.zeros(max(need - len(a), len(a)), a.dtype)]))

    def add(self, words: list[str]) -> None:
        """Adds words that aren't there yet."""
        for w in [w for w in words if len(w) > LONG]:
            self._add_long(w)
        words = sorted(w for w in words if len(w) <= LONG)
        part = np.cumsum([len(w) for w in words]) // ADDED_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(words)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                self._add(words[a:b])

    def _add_long(self, word: str) -> None:
        """Adds one word: its edges from all places at once, then their sums."""
        v, length = self.vocabulary, len(word)
        chars = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        start, key, k = np.arange(length), np.zeros(length, np.uint64), 0
        starts, ends, pieces = [], [], []
        while len(start):
            key = extend(key, chars[start + k].astype(np.uint64))
            slot = v.find(key)
            piece, begun = v.slot_piece[slot], v.slot_inner[slot]
            if k == 0:  # characters without a piece
                piece = np.where(piece < 0, -1 - chars.astype(np.int32), piece)
            whole = (piece >= 0) | (k == 0)
            k += 1
            starts.append(start[whole])
            ends.append(start[whole] + k)
            pieces.append(piece[whole])
            go = begun & (start + k < length)
            start, key = start[go], key[go]
        source, end, piece = map(np.concatenate, (starts, ends, pieces))
        by = np.argsort(end, kind="stable")
        source, end, piece = source[by], end[by], piece[by]
        size = np.bincount(end, minlength=length + 1)[1:]
        weights, sources, forward, b = np.where(piece < 0, v.floor, v.log_weight[np.maximum(piece, 0)]).tolist(), source.tolist(), [0.0], 0
        for n in size.tolist():
            a, b = b, b + n
            score = [forward[i] + w for i, w in zip(sources[a:b], weights[a:b])]
            most = max(score)
            forward.append(most + math.log(sum(math.exp(x - most) for x in score)))
        forward = np.array(forward)
        self._keep([word], np.array([length]), source, piece, np.exp(forward[source] + np.array(weights) - forward[end]), size)

    def _add(self, words: list[str]) -> None:
        """Adds words in order, all at once, place by place."""
        v, length = self.vocabulary, np.array([len(w) for w in words])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.cumsum(length) - length
        forward = np.zeros(1 + len(chars))  # by node; node 0 is the place before all
        nodes = 1
        word, end = np.arange(len(words)), np.empty(len(words), np.int64)
        node = np.zeros(len(words), np.int64)  # of each word, by its number among those of its place
        # for each node of a place, the pieces that may go on from there: where they start and the key of what there is
        counts, starts, keys = np.ones(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.uint64)
        sources, pieces, chances, sizes = [], [], [], []
        place = 0
        while len(word):
            char = chars[at[word] + place]
            new = np.ones(len(word), bool)  # words are in order, so those that begin alike are neighbours
            new[1:] = (node[1:] != node[:-1]) | (char[1:] != char[:-1])
            above, node, char = node[new], np.cumsum(new) - 1, char[new]
            n, place = len(char), place + 1
            had = counts[above]
            owner = np.repeat(np.arange(n), had)
            which = np.arange(len(owner)) + np.repeat((np.cumsum(counts) - counts)[above] - (np.cumsum(had) - had), had)
            start, key = starts[which], extend(keys[which], char[owner].astype(np.uint64))
            slot = v.find(key)
            piece, begun = v.slot_piece[slot], v.slot_inner[slot]
            lone = np.cumsum(had) - had  # the shortest of a node's comes first: its last character
            lone = lone[piece[lone] < 0]
            piece[lone] = -1 - char[owner[lone]].astype(np.int32)  # characters without a piece
            whole = piece >= 0
            whole[lone] = True
            source, piece, row = start[whole], piece[whole], owner[whole]
            size = np.bincount(row, minlength=n)  # each has one
            score = forward[source] + np.where(piece < 0, v.floor, v.log_weight[np.maximum(piece, 0)])
            cut = np.cumsum(size) - size
            most = np.maximum.reduceat(score, cut)
            own = most + np.log(np.add.reduceat(np.exp(score - most[row]), cut))
            forward[nodes : nodes + n] = own
            sources.append(source)
            pieces.append(piece)
            chances.append(np.exp(score - own[row]))
            sizes.append(size)
            done = length[word] == place
            end[word[done]] = nodes + node[done]
            word, node = word[~done], node[~done]
            # the next place: a piece may start here, and those begun go on
            counts = np.bincount(owner[begun], minlength=n) + 1
            fresh = np.cumsum(counts) - counts
            goes = np.ones(int(counts.sum()), bool)
            goes[fresh] = False
            starts, keys = np.empty(len(goes), np.int64), np.zeros(len(goes), np.uint64)
            starts[fresh], starts[goes], keys[goes] = nodes + np.arange(n), start[begun], key[begun]
            nodes += n
        self._keep(words, end, *map(np.concatenate, (sources, pieces, chances, sizes)))

    def _keep(self, words: list[str], end: np.ndarray, source: np.ndarray, piece: np.ndarray, chance: np.ndarray, size: np.ndarray) -> None:
        """Remembers edges, which come node by node; size: of each node but node 0; end: each word's last node."""
        cut = np.cumsum(size) - size
        by = np.arange(len(source))
        for k in range(2, int(size.max()) + 1):  # the likeliest first among a node's edges
            own = cut[size == k][:, None] + np.arange(k)
            by[own] = np.take_along_axis(own, np.argsort(-chance[own], axis=1, kind="stable"), axis=1)
        chance = chance[by]
        total = np.cumsum(chance)
        cumulative = total - np.repeat((total - chance)[cut], size)
        cumulative[cut + size - 1] = 2.0  # a node's last edge takes what is left
        for name in ("source", "piece", "cumulative"):
            self._grow(name, self.edges + len(by))
        first = np.append(-1, self.edges + cut)  # edge of each node
        own = slice(self.edges, self.edges + len(by))
        self.source[own], self.piece[own], self.cumulative[own] = first[source[by]], piece[by], cumulative
        self.ends.update(zip(words, first[end].tolist()))
        self.edges += len(by)

    def sample(self, texts: pa.Array | list[str], keys: list[int], seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts end to end, and where each text starts."""
        words, counts = segments(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        coded = words.dictionary_encode()
        if self.edges > REMEMBERED_EDGES:
            self.clear()
        known = coded.dictionary.to_pylist()
        new = [w for w in known if w not in self.ends]
        if new:
            self.add(new)
        edge = np.array([self.ends[w] for w in known], np.int64)[coded.indices.to_numpy()]
        base = mix64(np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], np.uint64) + np.uint64(seed * 0x9E3779B9 & 0xFFFFFFFFFFFFFFFF))
        nth = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        state = mix64(np.repeat(base, counts) + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        at = np.arange(len(words))
        drawn, owners = [], []
        step = 0
        while len(at):
            step += 1
            u = (mix64(state + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            more = np.flatnonzero(self.cumulative[edge] <= u)
            while len(more):
                edge[more] += 1
                more = more[self.cumulative[edge[more]] <= u[more]]
            drawn.append(self.piece[edge])
            owners.append(at)
            edge = self.source[edge]
            go = edge >= 0
            at, edge, state = at[go], edge[go], state[go]
        n = np.zeros(len(words), np.int64)
        for own in owners:
            n[own] += 1
        last = np.cumsum(n) - 1
        out = np.empty(int(n.sum()), np.int32)
        for back, (own, piece) in enumerate(zip(owners, drawn)):
            out[last[own] - back] = piece
        edges = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(counts)])]
        if (out < 0).any():
            out, edges = self._bytes(out, edges)
        return out, edges

    def _bytes(self, out: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece become the pieces of their bytes."""
        at = np.flatnonzero(out < 0)
        codes, which = np.unique(-1 - out[at], return_inverse=True)
        expanded = [chr(c).encode() for c in codes.tolist()]
        sizes = np.ones(len(out), np.int64)
        sizes[at] = np.array([len(b) for b in expanded])[which]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        new = np.zeros(starts[-1], np.int32)
        plain = out >= 0
        new[starts[:-1][plain]] = out[plain]
        for k in range(4):
            has = np.array([len(b) > k for b in expanded])[which]
            new[starts[at[has]] + k] = self.vocabulary.byte_ids[np.array([b[k] if len(b) > k else 0 for b in expanded])[which[has]]]
        return new, starts[edges]


_LATTICES: dict = {}


def lattices(model: bytes, alpha: float) -> Lattices:
    """One for each model in a worker: the vocabulary serves task after task, the lattices one task."""
    key = (xxhash.xxh64_intdigest(model), alpha)
    if key not in _LATTICES:
        _LATTICES[key] = Lattices(Vocabulary(model, alpha))
    return _LATTICES[key]


def row_keys(b: pa.RecordBatch) -> list[int]:
    """The key that seeds a row: its doc_id; null: 2**63."""
    return [2**63 if i is None else i for i in b.column("doc_id").cast(pa.int64()).to_pylist()]


def encode(docs: DataFrame, model_path: str | None = None, alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """doc_id, n_pieces, ids of every row, and whether decoding gives its text back (lossless)."""
    with open(model_path or default_model(), "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattices(model, alpha)
        try:
            for b in chunks(batches, "text", ENCODE_BYTES):
                texts = b.column("text").to_pylist()
                flat, edges = own.sample(b.column("text"), row_keys(b), seed)
                ids = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(flat))
                same = [back == (t or "").encode() for back, t in zip(own.vocabulary.decode(ids), texts)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(np.diff(edges)), ids, pa.array(same)], ["doc_id", "n_pieces", "ids", "lossless"])
        finally:  # the worker may serve another operator next
            own.clear()

    return map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_pieces long, ids array<int>, lossless boolean")


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids: null."""
    with open(model_path or default_model(), "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = lattices(model, ALPHA).vocabulary
        for b in batches:
            if b.num_rows:
                texts = [None if t is None else t.decode() for t in vocabulary.decode(b.column("ids"))]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents", "doc_id", "text"))
