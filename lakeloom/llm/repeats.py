"""Suffix-array deduplication of repeated byte strings.

maximal_repeats() is the core: an enhanced suffix array (suffixes sorted by prefix doubling, common prefixes
of neighbours from the rank tables), a stack scan over its common-prefix intervals, and a test of each
interval's left extensions. An interval whose occurrences are all preceded by one byte is part of a longer
repeat; the others are maximal repeats, given with all their occurrences.

To spread one array over a cluster, every window of WIDTH bytes is owned by its anchor: the leftmost of
its K-byte strings with the least hash. Equal windows have equal anchors, so the windows of a document
fall into runs (an anchor and the bytes its windows cover), and only runs with equal anchors need one
array:

1. Runs are dealt by their anchor's hash. Copies within a chunk are settled before, after their bytes are
   compared, so a passage that a third of all documents share is one row a chunk.
2. Runs whose anchor has another are looked up in their text and dealt by the anchor with their bytes;
   copies that a task holds are settled before that. Runs with equal bytes keep the first, different
   ones make one suffix array. Hashes only bring runs together; bytes decide.
3. An anchor with more than MAX_RUNS runs (a passage amid ever different text) is dealt by more of its
   bytes: each of its windows is a run of its own, known by all its bytes, so no task holds them all.

A byte goes if it lies in a string of WIDTH bytes that also starts earlier: at a smaller doc_id, or at a
smaller offset in the same document. Strings are judged on the input and never cross documents.

Edge cases: null text is empty; texts under WIDTH bytes stay whole; null doc_id comes before all others;
rows that share a doc_id (or have none) but not the text are documents of their own, in order of their
text's hash (80 bits); rows equal in both are one document, seen twice, and get the same result; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.common import Scratch, chunks, gathered, map_arrow, mix64, read, text_bytes

WIDTH = 100
K = 32
#: Runs of one anchor that are compared with one another; beyond that, window by window.
MAX_RUNS = 2_000
#: Bytes of runs in one array, unless one anchor has more.
ARRAY_BYTES = 1 << 18
#: Bytes that are hashed at once; what they need stays in a core's cache.
HASHED_BYTES = 1 << 15
#: Rows of runs (four longs each) that are handled at once.
DEALT_ROWS = 1 << 16
#: Bytes of looked-up runs among which a task settles copies.
COMBINED_BYTES = 32 << 20
NO_ID = -(2**63)

_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# --- the enhanced suffix array -----------------------------------------------------------------------


def maximal_repeats(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats of at least `least` bytes among strings data[starts[i]:ends[i]].

    Returns the suffixes' places in data, in order of the array; and for each maximal repeat its length
    and its first and last index in that order. Only suffixes that have `least` bytes are in the array. A
    suffix at a string's start has no known byte before it, which counts as a byte of its own.
    """
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes)
    old = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[owner]
    room = ends[owner] - old
    asked = np.flatnonzero(room >= least)
    none = np.zeros(0, np.int64)
    if not len(asked):
        return none, none, none, none
    # symbols 1 to 256, and a 0 after each string
    n, new = len(owner) + len(starts), np.arange(len(owner)) + owner
    text = np.zeros(n + _WORD, np.int64)
    text[new] = data[old].astype(np.int64) + 1
    word = np.zeros(n, np.int64)
    for j in range(_WORD):
        word = (word << 9) | text[j : j + n]
    ranks, widths = [_rank(word)], [_WORD]
    while widths[-1] < int(sizes.max()) and ranks[-1].max() + 1 < n:
        r, w = ranks[-1], widths[-1]
        after = np.zeros(n, np.int64)
        after[: max(n - w, 0)] = r[w:] + 1
        ranks.append(_rank(r * (n + 1) + after))
        widths.append(2 * w)
    asked = asked[np.argsort(ranks[-1][new[asked]], kind="stable")]
    at, place, room = new[asked], old[asked], room[asked]
    # common prefixes of neighbours: the greatest sum of widths at which the ranks agree, then symbols
    i, j, common = at[:-1], at[1:], np.zeros(max(len(at) - 1, 0), np.int64)
    for r, w in zip(ranks[::-1], widths[::-1]):
        common += w * (r[np.minimum(i + common, n - 1)] == r[np.minimum(j + common, n - 1)])
    open_ = np.ones(len(common), bool)
    for _ in range(_WORD - 1):
        open_ &= text[np.minimum(i + common, n)] == text[np.minimum(j + common, n)]
        common += open_
    common = np.minimum(common, np.minimum(room[1:], room[:-1]))
    before = np.where(np.isin(place, starts), -1 - np.arange(len(place)), data[np.maximum(place - 1, 0)])
    return place, *_scan(common, before, least)


#: Symbols of nine bits in the first ranks' words.
_WORD = 7


def _rank(keys: np.ndarray) -> np.ndarray:
    """The place of each key among the distinct ones."""
    order = np.argsort(keys)
    ordered = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
    return out


def _scan(common: np.ndarray, before: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The common-prefix intervals whose left extensions differ: length, first and last suffix."""
    found: list[tuple[int, int, int]] = []
    pairs = np.zeros(0, np.int64)
    hits = np.flatnonzero(common >= least)
    if len(hits):
        # stretches of neighbours that share enough; most are one pair
        lead = np.append(True, np.diff(hits) > 1)
        firsts, lasts = hits[lead], hits[np.append(lead[1:], True)] + 1
        pair = firsts + 1 == lasts
        pairs = firsts[pair][before[firsts[pair]] != before[lasts[pair]]]
        for first, last in zip(firsts[~pair].tolist(), lasts[~pair].tolist()):
            values, left = common[first:last].tolist(), before[first : last + 1].tolist()
            stack: list[list[int]] = []  # length, first suffix, left byte, whether left bytes differ
            for i, value in enumerate(values):
                begin, byte, mixed = i, left[i], 0
                while stack and stack[-1][0] > value:
                    length, begin, own, own_mixed = stack.pop()
                    own_mixed = own_mixed or own != byte or mixed
                    if own_mixed:
                        found.append((length, first + begin, first + i))
                    byte, mixed = own, own_mixed
                if stack and stack[-1][0] == value:
                    top = stack[-1]
                    top[3] = top[3] or mixed or top[2] != byte
                else:
                    stack.append([value, begin, byte, mixed])
            byte, mixed, end = left[len(values)], 0, first + len(values)
            while stack:
                length, begin, own, own_mixed = stack.pop()
                own_mixed = own_mixed or mixed or own != byte
                if own_mixed:
                    found.append((length, first + begin, end))
                byte, mixed = own, own_mixed
    out = np.array(found, np.int64).reshape(-1, 3)
    return np.append(common[pairs], out[:, 0]), np.append(pairs, out[:, 1]), np.append(pairs + 1, out[:, 2])


# --- windows, anchors, runs --------------------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all K-byte strings (K a power of 2)."""
    out = np.empty(max(len(data) - K + 1, 0), np.uint64)
    for a in range(0, len(out), HASHED_BYTES):
        h, size = _BYTE[data[a : a + HASHED_BYTES + K - 1]], 1
        while size < K:
            h = mix64(h[:-size] * np.uint64(0xD1342543DE82EF95) + h[size:])
            size *= 2
        out[a : a + HASHED_BYTES] = h
    return out


def anchors(h: np.ndarray, span: int) -> np.ndarray:
    """The place of the least of `span` hashes (their upper halves) from each place on; the leftmost of equal ones."""
    out = np.empty(max(len(h) - span + 1, 0), np.int64)
    for a in range(0, len(out), HASHED_BYTES):
        low = h[a : a + HASHED_BYTES + span - 1]
        low, size = ((low >> np.uint64(32)) << np.uint64(32)) | np.arange(len(low), dtype=np.uint64), 1
        while size * 2 <= span:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < span:
            low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
        out[a : a + HASHED_BYTES] = (low & np.uint64(0xFFFFFFFF)).astype(np.int64) + a
    return out


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first window, number of windows less 1, anchor's offset in the run, anchor and content hashes."""
    span = WIDTH - K + 1
    h = gram_hashes(data)
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < WIDTH:
        return none
    anchor = anchors(h, span)  # of the window at each place
    sizes = np.diff(offsets)
    own = np.maximum(sizes - WIDTH + 1, 0)  # windows of each document
    new = np.append(True, anchor[1:] != anchor[:-1])
    new[offsets[:-1][own > 0]] = True
    new &= np.repeat(np.tile([True, False], len(own)), np.stack([own, sizes - own], 1).ravel())[: len(new)]
    p0 = np.flatnonzero(new)
    if not len(p0):
        return none
    row = np.searchsorted(offsets, p0, side="right") - 1
    more = np.minimum(np.append(p0[1:], len(data)), offsets[row] + own[row]) - p0 - 1
    at = anchor[p0]
    end = p0 + more + WIDTH
    content = (more * 256 + (at - p0)).astype(np.uint64)
    for j in range((span + WIDTH) // K):
        content = mix64(content * np.uint64(0x9E3779B97F4A7C15) + h[np.minimum(p0 + K * j, end - K)])
    content = mix64(content + h[end - K])
    return row, p0 - offsets[row], more, at - p0, h[at], content


def pack(tag, start, more, off, settled):
    """Version tag (16 bits), start (31), windows less 1 and anchor offset (7 each), whether it is settled."""
    return (tag << 46) | (start << 15) | (more << 8) | (off << 1) | settled


def unpack(packed):
    """Tag, start, windows less 1, anchor offset."""
    return packed >> 46, (packed >> 15) & 0x7FFFFFFF, (packed >> 8) & 127, (packed >> 1) & 127


def version(text: bytes) -> int:
    """16 bits beside Spark's 64-bit hash of the text."""
    return xxhash.xxh3_64_intdigest(text) & 0xFFFF


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64)) for c in columns], names.split())


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray, step: int = 4096) -> np.ndarray:
    """Whether the size[i] bytes at a[i] and at b[i] are equal; sizes are positive."""
    out = np.zeros(len(a), bool)
    for k in range(0, len(a), step):
        n = size[k : k + step]
        first = np.cumsum(n) - n
        along = np.arange(int(n.sum())) - np.repeat(first, n)
        same = data[np.repeat(a[k : k + step], n) + along] == data[np.repeat(b[k : k + step], n) + along]
        out[k : k + step] = np.logical_and.reduceat(same, first)
    return out


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs of the documents; those that the chunk itself has earlier are settled."""
    for b in chunks(batches, "text"):
        data, offsets = text_bytes(b.column("text"))
        row, start, more, off, h, c = runs(data, offsets)
        if not len(row):
            continue
        raw = data.tobytes()
        tag = np.array([version(raw[x:y]) for x, y in zip(offsets, offsets[1:])], np.int64)[row]
        ids, v = _ids(b.column("doc_id"))[row], b.column("v").to_numpy()[row]
        settled, again = np.zeros(len(row), np.int64), np.zeros(len(row), bool)
        key = mix64(h) + c
        order = np.argsort(key, kind="stable")
        same = np.append(False, key[order][1:] == key[order][:-1])
        if same.any():
            group = np.cumsum(~same) - 1
            held = np.flatnonzero(same | np.append(same[1:], False))
            at, g = order[held], group[held]
            by = np.lexsort((start[at], tag[at], v[at], ids[at], g))
            at, g = at[by], g[by]
            lead = np.append(True, g[1:] != g[:-1])
            least = at[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
            at, least = at[~lead], least[~lead]
            alike = (more[at] == more[least]) & (off[at] == off[least])
            at, least = at[alike], least[alike]
            alike = _equal(data, offsets[row[at]] + start[at], offsets[row[least]] + start[least], more[at] + WIDTH)
            at, least = at[alike], least[alike]
            one = (ids[at] == ids[least]) & (v[at] == v[least]) & (tag[at] == tag[least]) & (start[at] == start[least])
            settled[at[~one]] = 1
            again[at[one]] = True  # the same document, twice in the chunk
        packed = pack(tag, start, more, off, settled)
        # settled runs meet no others; they are dealt at random
        h = np.where(settled == 1, mix64(packed.astype(np.uint64) + ids.astype(np.uint64)), h)
        yield _batch("h id v packed", h[~again], ids[~again], v[~again], packed[~again])


def _share(most: int):
    """From runs in order of h: settled ones (kind 0), those whose anchor has another (1), or more than `most` (2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, beyond = None, None  # runs of the last anchor, at most `most`; the anchor that has more
        for b in gathered(batches, DEALT_ROWS):
            rows = np.stack([x.to_numpy() for x in b.columns])
            settled = (rows[3] & 1) == 1
            out = [np.vstack([np.zeros(int(settled.sum()), np.int64), rows[:, settled]])]
            rows = rows[:, ~settled]
            if held is not None:
                rows, held = np.concatenate([held, rows], axis=1), None
            if rows.shape[1]:
                h = rows[0]
                cut = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                size = np.diff(np.append(cut, len(h)))
                kind = np.where(size < 2, -1, np.where(size > most, 2, 1))
                if beyond is not None and h[0] == beyond:
                    kind[0] = 2
                if kind[-1] == 2:
                    beyond = h[-1]
                else:
                    held, kind[-1] = rows[:, cut[-1] :], -1
                kind = np.repeat(kind, size)
                out.append(np.vstack([kind, rows])[:, kind > 0])
            yield _batch("kind h id v packed", *np.concatenate(out, axis=1))
        if held is not None and held.shape[1] > 1:
            yield _batch("kind h id v packed", np.ones(held.shape[1], np.int64), *held)

    return run


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that are to be compared, from their document's text; copies at hand are settled.

    Of runs with equal key and bytes the first keeps its bytes; others have none.
    """
    held: dict[tuple[int, bytes], tuple[int, int, int]] = {}
    size = 0
    gone: list[tuple[int, int, int]] = []

    def flush() -> pa.RecordBatch:
        rows = [(k, *place, raw) for (k, raw), place in held.items()]
        rows += [(hash((i, v, p)), i, v, p, None) for i, v, p in gone]  # dealt at random
        held.clear(), gone.clear()
        cols = list(zip(*rows)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in cols[:4]), pa.array(cols[4], pa.binary())], ["h", "id", "v", "packed", "bytes"])

    def add(key: int, place: tuple[int, int, int], raw: bytes) -> int:
        first = held.setdefault((key, raw), place)
        if first is place:
            return len(raw)
        if place < first:
            held[key, raw], place = place, first
        if place != first or held[key, raw] != first:
            gone.append(place)
        return 0

    for b in chunks(batches, "text"):
        for text, own, i, v in zip(b.column("text").to_pylist(), b.column("found").to_pylist(), _ids(b.column("doc_id")).tolist(), b.column("v").to_pylist()):
            raw = (text or "").encode()
            tag = version(raw)
            for r in own:
                t, start, more, off = unpack(r["packed"])
                if t != tag:
                    continue
                if r["kind"] == 1:
                    size += add(r["h"], (i, v, r["packed"]), raw[start : start + more + WIDTH])
                    continue
                for k in range(more + 1):  # window by window
                    w = raw[start + k : start + k + WIDTH]
                    size += add(xxhash.xxh3_64_intdigest(w) - (1 << 63), (i, v, pack(tag, start + k, 0, off - k, 0)), w)
            if size > COMBINED_BYTES:
                yield flush()
                size = 0
    if held or gone:
        yield flush()


_SPANS = "id v tag start end"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that go, from looked-up runs in order of (h, id, v, packed)."""

    def array(rows: list[tuple[int, int, int]], raw: list[bytes]) -> pa.RecordBatch:
        ids, vs, packed = np.array(rows, np.int64).T
        tag, begin, _, _ = unpack(packed)
        ends = np.cumsum([len(r) for r in raw])
        starts = ends - np.array([len(r) for r in raw])
        data = np.frombuffer(b"".join(raw), np.uint8)
        place, length, lo, hi = maximal_repeats(data, starts, ends, WIDTH)
        run = np.searchsorted(ends, place, side="right")
        at = begin[run] + place - starts[run]
        keys = (at, tag[run], vs[run], ids[run])
        by = np.lexsort(keys)
        new = np.zeros(len(by), bool)
        for x in keys:
            new[1:] |= x[by][1:] != x[by][:-1]
        rank = np.empty(len(place), np.int64)
        rank[by] = np.cumsum(new)
        sizes = hi - lo + 1
        member = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo, sizes)
        ranks = rank[member]
        if len(sizes):
            earliest = np.minimum.reduceat(ranks, np.cumsum(sizes) - sizes)
            later = ranks > np.repeat(earliest, sizes)
        else:
            later = np.zeros(0, bool)
        gone, size = member[later], np.repeat(length, sizes)[later]
        # one row for each stretch of a run that goes, however many repeats cover it
        owner = run[gone] << 32
        by = np.argsort(owner + at[gone], kind="stable")
        first, last = (owner + at[gone])[by], (owner + at[gone] + size)[by]
        reach = np.maximum.accumulate(last) if len(last) else last
        lead = np.append(True, first[1:] > reach[:-1])[: len(first)]
        first, last = first[lead], reach[np.append(lead[1:], True)[: len(reach)]]
        owner, low = first >> 32, 0xFFFFFFFF
        return _batch(_SPANS, ids[owner], vs[owner], tag[owner], first & low, last & low)

    rows: list[tuple[int, int, int]] = []  # first runs of complete anchors that have several
    raw: list[bytes] = []
    own: dict[bytes, tuple[int, int, int]] = {}  # the first run of each content at the anchor at hand
    gone: list[tuple[int, int, int]] = []  # runs that go whole
    now, size = None, 0

    def whole() -> pa.RecordBatch:
        ids, vs, packed = np.array(gone, np.int64).reshape(-1, 3).T
        tag, begin, more, _ = unpack(packed)
        gone.clear()
        return _batch(_SPANS, ids, vs, tag, begin, begin + more + WIDTH)

    for b in batches:
        for h, i, v, p, data in zip(*(c.to_pylist() for c in b.columns)):
            if h != now:
                if len(own) > 1:
                    rows += own.values()
                    raw += own
                    size += sum(map(len, own))
                    if size > ARRAY_BYTES:
                        yield array(rows, raw)
                        rows, raw, size = [], [], 0
                own, now = {}, h
            place = (i, v, p)
            if data is None or own.setdefault(data, place) != place:
                gone.append(place)
        if gone:
            yield whole()
    if len(own) > 1:
        rows += own.values()
        raw += own
    if rows:
        yield array(rows, raw)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The result of each document from its text and the spans that go."""
    for b in chunks(batches, "text"):
        rows = []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            raw = (text or "").encode()
            tag = version(raw) if spans else 0
            own = np.array([(s["start"], s["end"]) for s in spans or () if s["tag"] == tag], np.int64).reshape(-1, 2)
            if len(own):
                own = own[np.argsort(own[:, 0], kind="stable")]
                reach = np.maximum.accumulate(own[:, 1])
                first = np.append(True, own[1:, 0] > reach[:-1])
                begin, end = own[first, 0], reach[np.append(first[1:], True)]
                edges = [0, *np.stack([begin, end], 1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
                rows.append((len(raw), int((end - begin).sum()), len(begin), kept))
            else:
                rows.append((len(raw), 0, 0, raw))
        n, removed, spans, kept = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), *(pa.array(x, pa.int64()) for x in (n, removed, spans)), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and what names a document: id (null: NO_ID) and v, its text's hash."""
    return docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("v"))


def spans_to_remove(docs: DataFrame, scratch: Scratch, most: int = MAX_RUNS) -> DataFrame:
    """(id, v, tag, start, end) of all spans that go; they may overlap. A null doc_id is NO_ID."""
    keyed = _keyed(docs)
    dealt = map_arrow(keyed.select("doc_id", "text", "v"), _deal, "h long, id long, v long, packed long")
    dealt = dealt.repartition("h").sortWithinPartitions("h")
    first = scratch.save(map_arrow(dealt, _share(most), "kind long, h long, id long, v long, packed long"), "first")
    # sets: rows equal in doc_id and text ask once
    asked = first.where("kind > 0").groupBy("id", "v").agg(F.collect_set(F.struct("kind", "h", "packed")).alias("found"))
    looked = map_arrow(keyed.join(asked, ["id", "v"]).select("doc_id", "text", "v", "found"), _look_up, "h long, id long, v long, packed long, bytes binary")
    looked = looked.repartition("h").sortWithinPartitions("h", "id", "v", "packed")
    compared = scratch.save(map_arrow(looked, _compare, ", ".join(f"{n} long" for n in _SPANS.split())), "compared")
    start = F.shiftright("packed", 15).bitwiseAND(0x7FFFFFFF)
    whole = first.where("kind = 0").select("id", "v", F.shiftright("packed", 46).alias("tag"), start.alias("start"), (start + F.shiftright("packed", 8).bitwiseAND(127) + WIDTH).alias("end"))
    return whole.unionByName(compared)


def cut_repeats(docs: DataFrame, scratch: Scratch | None = None, most: int = MAX_RUNS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes left) of every row."""
    scratch = scratch or Scratch(docs.sparkSession, "repeats", shuffled=True)
    spans = spans_to_remove(docs, scratch, most).groupBy("id", "v").agg(F.collect_set(F.struct("tag", "start", "end")).alias("spans"))
    spans = scratch.save(spans, "spans")
    scratch.drop("first", "compared")
    return map_arrow(_keyed(docs).join(spans.hint("merge"), ["id", "v"], "left").select("doc_id", "text", "spans"), _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = cut_repeats(read(spark, sf_dir, "documents", "doc_id", "text"))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple], width: int = WIDTH) -> dict[tuple, tuple[int, int, int, str]]:
    """The query's result in plain Python, for tests: rows of doc_id, text and its hash, keyed by id and hash."""
    seen, out = set(), {}
    for doc, v, text in sorted({(d, v, t or "") for d, t, v in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - width + 1):
            w = raw[i : i + width]
            if w in seen:
                gone[i : i + width] = True
            else:
                seen.add(w)
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        n = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out[doc, v] = (len(raw), int(gone.sum()), n, hashlib.sha256(kept).hexdigest())
    return out
