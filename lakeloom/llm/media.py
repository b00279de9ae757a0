"""Media columns: baseline JPEG written and read in numpy.

A payload of bytes becomes the DC coefficients of flat 8x8 blocks, one byte a block: with the DC
quantiser at 8 the quantised coefficient is byte - 128, so the DC-only luminance thumbnail (one sample
a block) is the payload again, exactly. Frames are 24 blocks wide with a restart marker after each row;
longer payloads become several frames end to end.

The reader handles any baseline JPEG (Huffman tables, sampling factors, restarts, AC coefficients are
skipped): it parses markers, then decodes all restart intervals of all frames with equal tables in
lockstep, one numpy lane an interval. Frames that aren't baseline or break off raise ValueError.

Edge cases: null text is an empty payload, i.e. 576 bytes of 255; equal texts give equal media; very
long texts give more frames; repeated rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm.common import chunks, map_arrow, read, text_bytes

UNIT = 576
WIDTH = 24
#: Payload bytes a frame: its height in pixels must be below 65,536.
FRAME = UNIT * 341

# The DC luminance code lengths of ITU-T T.81, table K.3; symbols are 0 to 11 in order.
DC_COUNTS = [0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0]
DC_SYMBOLS = list(range(12))
# Own AC table: the end-of-block symbol alone, one bit.
AC_COUNTS = [1] + [0] * 15
AC_SYMBOLS = [0]


def canonical(counts: list[int], symbols: list[int]) -> list[tuple[int, int, int]]:
    """(symbol, code, length) of a Huffman table as JPEG stores it."""
    out, code, k = [], 0, 0
    for length, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((symbols[k], code, length))
            code, k = code + 1, k + 1
        code <<= 1
    return out


def lookup(counts: list[int], symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length for each 16 bits that may come next; length 0: no code."""
    symbol, length = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint8)
    for s, code, n in canonical(counts, symbols):
        a = code << (16 - n)
        symbol[a : a + (1 << (16 - n))], length[a : a + (1 << (16 - n))] = s, n
    return symbol, length


def _code_table() -> tuple[np.ndarray, np.ndarray]:
    """Bits and their number for each DC difference from -255 to 255, with the end of block."""
    codes = {s: (c, n) for s, c, n in canonical(DC_COUNTS, DC_SYMBOLS)}
    bits, sizes = np.zeros(511, np.uint32), np.zeros(511, np.int64)
    for d in range(-255, 256):
        size = abs(d).bit_length()
        c, n = codes[size]
        value = d if d >= 0 else d + (1 << size) - 1
        bits[d + 255], sizes[d + 255] = ((c << size) | value) << 1, n + size + 1
    return bits, sizes


_BITS, _SIZES = _code_table()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def header(rows: int) -> bytes:
    """All of a frame before its entropy-coded data."""
    return b"".join(
        [
            b"\xff\xd8",
            _segment(0xDB, b"\0" + b"\x08" * 64),
            _segment(0xC0, struct.pack(">BHHB", 8, rows * 8, WIDTH * 8, 1) + b"\x01\x11\x00"),
            _segment(0xC4, b"\x00" + bytes(DC_COUNTS) + bytes(DC_SYMBOLS)),
            _segment(0xC4, b"\x10" + bytes(AC_COUNTS) + bytes(AC_SYMBOLS)),
            _segment(0xDD, struct.pack(">H", WIDTH)),
            _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00"),
        ]
    )


def encode(samples: np.ndarray, frame_rows: list[int]) -> list[bytes]:
    """Frames of frame_rows[i] rows of WIDTH samples each, taken in order from `samples`."""
    v = samples.reshape(-1, WIDTH).astype(np.int16) - 128
    d = v.copy()
    d[:, 1:] -= v[:, :-1]
    d = d.astype(np.int64) + 255
    sizes = _SIZES[d]
    row_bits = sizes.sum(axis=1)
    row_bytes = (row_bits + 7) >> 3
    row_start = np.cumsum(row_bytes) - row_bytes
    at = (np.cumsum(sizes, axis=1) - sizes + (row_start * 8)[:, None]).ravel()
    code = (_BITS[d.ravel()] << (24 - sizes.ravel() - (at & 7)).astype(np.uint32)).astype(np.uint32)
    at >>= 3
    n = int(row_bytes.sum())
    packed = np.zeros(n + 2, np.float64)
    for k, shift in enumerate((16, 8, 0)):  # codes don't overlap, so sums are unions of bits
        packed += np.bincount(at + k, weights=((code >> np.uint32(shift)) & np.uint32(255)), minlength=n + 2)[: n + 2]
    packed = packed[:n].astype(np.uint8)
    packed[row_start + row_bytes - 1] |= ((1 << (row_bytes * 8 - row_bits)) - 1).astype(np.uint8)
    # stuff a zero after each 255, and put restart markers between a frame's rows
    stuffed = packed == 255
    rows = np.array(frame_rows)
    first = np.cumsum(rows) - rows
    no_marker = np.zeros(len(v), bool)
    no_marker[first] = True
    in_frame = np.arange(len(v)) - np.repeat(first, rows)
    marker_room = np.where(no_marker, 0, 2)
    row_pos = row_start + np.cumsum(marker_room)
    pos = np.arange(n) + np.cumsum(stuffed) - stuffed + np.repeat(np.cumsum(marker_room), row_bytes)
    before = np.cumsum(stuffed) - stuffed
    out = np.zeros(n + int(stuffed.sum()) + int(marker_room.sum()), np.uint8)
    out[pos] = packed
    marked = np.flatnonzero(~no_marker)
    where = row_pos[marked] + before[row_start[marked]] - 2
    out[where], out[where + 1] = 0xFF, 0xD0 + ((in_frame[marked] - 1) & 7)
    starts = np.append(pos[row_start[first]], len(out))
    return [header(r) + out[a:b].tobytes() + b"\xff\xd9" for r, a, b in zip(frame_rows, starts, starts[1:])]


class Frame:
    """What the markers of one baseline JPEG say, and where its scan lies."""

    def __init__(self, data: bytes, start: int = 0, stops: np.ndarray | None = None):
        """stops: places of all markers in data that end a scan; found here if not given."""
        if data[start : start + 2] != b"\xff\xd8":
            raise ValueError("no start of image")
        at, quant, tables, self.restart = start + 2, {}, {}, 0
        while True:
            if data[at : at + 1] != b"\xff":
                raise ValueError("no marker where one must be")
            marker = data[at + 1]
            if marker == 0xFF:
                at += 1
                continue
            size = int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + size]
            if len(body) != size - 2:
                raise ValueError("a segment breaks off")
            at += 2 + size
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")  # of DC alone
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xC4:
                while body:
                    counts = list(body[1:17])
                    tables[body[0]] = (tuple(counts), tuple(body[17 : 17 + sum(counts)]))
                    body = body[17 + sum(counts) :]
            elif marker == 0xC0:
                precision, self.height, self.width, n = struct.unpack(">BHHB", body[:6])
                if precision != 8 or not self.height or not self.width:
                    raise ValueError("not 8 bits, or no size")
                parts = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)}
            elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                raise ValueError("not baseline")
            elif marker == 0xDD:
                self.restart = int.from_bytes(body, "big")
            elif marker == 0xDA:
                break
        scan = [(body[1 + 2 * i], body[2 + 2 * i]) for i in range(body[0])]
        if len(scan) != len(parts):
            raise ValueError("a scan must hold all components")
        single = len(scan) == 1
        self.h, self.v = (1, 1) if single else parts[scan[0][0]][:2]
        hmax, vmax = (1, 1) if single else (max(p[0] for p in parts.values()), max(p[1] for p in parts.values()))
        self.across, self.down = -(-self.width // (8 * hmax)), -(-self.height // (8 * vmax))
        self.quant = quant[parts[scan[0][0]][2]]
        # one entry for each block of an MCU: component, DC table, AC table
        self.pattern = tuple((k, tables[t >> 4], tables[16 + (t & 15)]) for k, (c, t) in enumerate(scan) for _ in range(1 if single else parts[c][0] * parts[c][1]))
        stops = scan_ends(data) if stops is None else stops
        nth = int(np.searchsorted(stops, at))
        if nth == len(stops):
            raise ValueError("the scan breaks off")
        end = int(stops[nth])
        self.scan = np.frombuffer(data, np.uint8)[at:end]
        self.end = end + 2


def scan_ends(data: bytes) -> np.ndarray:
    """Places of all markers but restarts, in one pass."""
    raw = np.frombuffer(data, np.uint8)
    ff = np.flatnonzero(raw[:-1] == 255)
    after = raw[ff + 1]
    return ff[(after != 0) & ((after < 0xD0) | (after > 0xD7))]


def decode(media: bytes) -> list[Frame]:
    """The frames of a media value, markers parsed."""
    out, at, stops = [], 0, scan_ends(media)
    while at < len(media):
        out.append(Frame(media, at, stops))
        at = out[-1].end
    return out


def thumbnails(frames: list[Frame]) -> list[np.ndarray]:
    """Each frame's DC-only luminance, one sample for each 8x8 block."""
    out: list = [None] * len(frames)
    alike: dict = {}
    for i, f in enumerate(frames):
        alike.setdefault(f.pattern, []).append(i)
    for pattern, members in alike.items():
        for i, thumb in zip(members, _lockstep([frames[i] for i in members], pattern)):
            out[i] = thumb
    return out


def _lockstep(frames: list[Frame], pattern: tuple) -> list[np.ndarray]:
    data = np.concatenate([x for f in frames for x in (f.scan, np.array([255, 0xD0], np.uint8))])
    ff = np.flatnonzero(data[:-1] == 255)
    after = data[ff + 1]
    keep = np.ones(len(data), bool)
    keep[ff[after == 0] + 1] = False
    cut = ff[(after >= 0xD0) & (after <= 0xD7)]
    keep[cut] = keep[cut + 1] = False
    kept = np.cumsum(keep)
    starts = np.concatenate([[0], kept[cut + 1][:-1]])
    data = np.concatenate([data[keep], np.zeros(8, np.uint8)]).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    mcus = np.concatenate([_intervals(f) for f in frames])
    if len(mcus) != len(starts):
        raise ValueError("restart markers don't fit the size")
    ends = np.append(starts[1:], len(data) - 8) * 8
    bit = starts.astype(np.int64) * 8
    limit = len(window) - 1

    def peek(p):
        return (window[np.minimum(p >> 3, limit)] << (p & 7).astype(np.uint32)) >> np.uint32(16)

    tables = {t: lookup(list(t[0]), list(t[1])) for _, dc, ac in pattern for t in (dc, ac)}
    blocks0 = sum(1 for c, _, _ in pattern if c == 0)
    lane_first = np.cumsum(mcus * blocks0) - mcus * blocks0
    values = np.zeros(int((mcus * blocks0).sum()), np.int32)
    last = np.zeros((max(c for c, _, _ in pattern) + 1, len(mcus)), np.int32)
    lanes = np.arange(len(mcus))
    for step in range(int(mcus.max(initial=0))):
        if step and (mcus[lanes] <= step).any():
            lanes = lanes[mcus[lanes] > step]
        nth = 0
        for component, dc, ac in pattern:
            p = bit[lanes]
            symbol, length = tables[dc]
            w = peek(p)
            size, used = symbol[w].astype(np.int64), length[w]
            if not used.all():
                raise ValueError("no such code")
            p = p + used
            raw = (peek(p).astype(np.int64)) >> (16 - size)
            p = p + size
            raw = np.where(raw < (1 << size) >> 1, raw - (1 << size) + 1, raw)
            pred = last[component, lanes] + raw.astype(np.int32)
            last[component, lanes] = pred
            if component == 0:
                values[lane_first[lanes] + step * blocks0 + nth] = pred
                nth += 1
            symbol, length = tables[ac]
            todo, k = np.arange(len(lanes)), np.ones(len(lanes), np.int64)
            while len(todo):  # skip AC coefficients
                w = peek(p[todo])
                s, used = symbol[w].astype(np.int64), length[w]
                if not used.all():
                    raise ValueError("no such code")
                p[todo] += used + (s & 15)
                k[todo] += (s >> 4) + 1
                todo = todo[(s != 0) & (k[todo] < 64)]
            bit[lanes] = p
            if (p > ends[lanes]).any():
                raise ValueError("the scan breaks off")
    out, at = [], 0
    for f in frames:
        n = f.across * f.down * blocks0
        grid = values[at : at + n].reshape(f.down, f.across, f.v, f.h).transpose(0, 2, 1, 3).reshape(f.down * f.v, f.across * f.h)
        at += n
        out.append(np.clip(np.rint(grid * (f.quant / 8)) + 128, 0, 255).astype(np.uint8))
    return out


def _intervals(f: Frame) -> np.ndarray:
    """MCUs in each restart interval."""
    n = f.across * f.down
    each = f.restart or n
    out = np.full(-(-n // each), each, np.int64)
    out[-1] = n - each * (len(out) - 1)
    return out


def thumbnail_hash(thumb: np.ndarray) -> str:
    """64 bits: of an 8x9 reduction, whether each mean is below its right neighbour's."""
    rows, cols = (np.arange(k) * n // k for k, n in ((8, thumb.shape[0]), (9, thumb.shape[1])))
    small = np.add.reduceat(np.add.reduceat(thumb.astype(np.int64), rows, axis=0), cols, axis=1)
    area = np.outer(np.maximum(np.diff(np.append(rows, thumb.shape[0])), 1), np.maximum(np.diff(np.append(cols, thumb.shape[1])), 1))
    small = small / area
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def store(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The media value of each row's bytes, padded with 255 to a positive multiple of UNIT."""
    sizes = np.diff(offsets)
    padded = np.maximum(-(-sizes // UNIT), 1) * UNIT
    payload = np.full(int(padded.sum()), 255, np.uint8)
    shift = (np.cumsum(padded) - padded) - offsets[:-1]
    payload[np.arange(len(data)) + np.repeat(shift, sizes)] = data
    rows, owner = [], []
    for i, n in enumerate(padded.tolist()):
        while n > 0:
            rows.append(min(n, FRAME) // WIDTH)
            owner.append(i)
            n -= FRAME
    frames = encode(payload, rows)
    own: list[list[bytes]] = [[] for _ in padded]
    for i, f in zip(owner, frames):
        own[i].append(f)
    return [b"".join(fs) for fs in own]


def read_back(media: list[bytes]) -> list[tuple[bytes, str]]:
    """Payload and feature (sizes in pixels and thumbnail hashes) of each media value."""
    parsed = [decode(m) for m in media]
    thumbs = iter(thumbnails([f for fs in parsed for f in fs]))
    out = []
    for fs in parsed:
        own = [next(thumbs) for _ in fs]
        feature = ",".join(f"{f.width}x{f.height}:{thumbnail_hash(t)}" for f, t in zip(fs, own))
        out.append((b"".join(t.tobytes() for t in own), feature))
    return out


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def media_column(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """Digests of each text's stored payload, read back; with keep_media also the media itself."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            data, offsets = text_bytes(b.column("text"))
            media = store(data, offsets)
            back = read_back(media)
            cols = [
                b.column("doc_id").cast(pa.int64()),
                pa.array(np.diff(offsets), pa.int64()),
                pa.array([len(p) for p, _ in back], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p, _ in back], pa.string()),
                pa.array([zlib.crc32(p[-32:]) for p, _ in back], pa.int64()),
                pa.array([len(m) for m in media], pa.int64()),
                pa.array([hashlib.sha256(m).hexdigest() for m in media], pa.string()),
                pa.array([f for _, f in back], pa.string()),
            ] + ([pa.array(media, pa.binary())] if keep_media else [])
            names = [c.split()[0] for c in SCHEMA.split(", ")] + ["media"] * keep_media
            yield pa.RecordBatch.from_arrays(cols, names)

    return map_arrow(docs.select("doc_id", "text"), convert, SCHEMA + ", media binary" * keep_media)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_column(read(spark, sf_dir, "documents", "doc_id", "text"))
