"""Media columns: AVI files of motion JPEG, written, parsed by their RIFF index, decoded, and cut into shots.

Frames are lossless JPEG (process 14, SOF3: 8-bit samples, predicted from the left), since the DCT processes of JPEG do
not keep every byte. Each row of samples is a restart interval, so all rows of all frames of a batch decode side by side.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.llm.common import ids_and_texts

WIDTH, HEIGHT, FPS = 64, 16, 25
#: Bits of the codes of difference categories 0 to 8: a fixed table for text bytes. Shorter codes come first.
CATEGORY_BITS = (5, 4, 4, 3, 2, 3, 4, 2, 6)
WINDOW_BITS = 14
#: Samples that one vectorised step takes.
STEP_BYTES = 1 << 21
#: A cut is where two histograms differ by more than the mean of the last frames' differences and so many deviations.
HISTORY, DEVIATIONS, LEAST = 12, 3.0, 0.12
BINS = 16


def _huffman() -> tuple[list[int], list[int], dict[int, tuple[int, int]]]:
    """Counts by length and categories in order, as DHT has them, and (code, bits) by category."""
    order = sorted(range(9), key=lambda c: (CATEGORY_BITS[c], c))
    counts = [sum(b == n for b in CATEGORY_BITS) for n in range(1, 17)]
    codes, code, last = {}, 0, 0
    for c in order:
        n = CATEGORY_BITS[c]
        code <<= n - last
        codes[c], last = (code, n), n
        code += 1
    assert code < 1 << last, "a code of ones alone is not allowed"
    return counts, order, codes


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Code with its extra bits, and their number, by difference + 255."""
    _, _, codes = _huffman()
    value, bits = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        c = abs(d).bit_length()
        code, n = codes[c]
        value[d + 255] = code << c | (d if d >= 0 else d + (1 << c) - 1)
        bits[d + 255] = n + c
    return value, bits


def lookup(counts: list[int], order: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Difference and bits used, by the next WINDOW_BITS bits, for any DHT of categories 0 to 8 whose codes fit."""
    diff, used = np.zeros(1 << WINDOW_BITS, np.int16), np.zeros(1 << WINDOW_BITS, np.int8)
    code, k = 0, 0
    for n, many in enumerate(counts, 1):
        for _ in range(many):
            c = order[k]
            for extra in range(1 << c):
                d = extra if c == 0 or extra >> (c - 1) else extra - (1 << c) + 1
                rest = WINDOW_BITS - n - c
                if rest < 0:
                    raise ValueError("codes are too long")
                at = (code << c | extra) << rest
                diff[at : at + (1 << rest)] = d
                used[at : at + (1 << rest)] = n + c
            code += 1
            k += 1
        code <<= 1
    return diff, used


_VALUE, _BITS = _tables()
_COUNTS, _ORDER, _ = _huffman()
_FRAME_HEAD = b"".join(
    [
        b"\xff\xd8",
        b"\xff\xc3" + struct.pack(">HBHHB", 11, 8, HEIGHT, WIDTH, 1) + bytes([1, 0x11, 0]),
        b"\xff\xc4" + struct.pack(">H", 2 + 17 + 9) + bytes([0, *_COUNTS, *_ORDER]),
        b"\xff\xdd" + struct.pack(">HH", 4, WIDTH),
        b"\xff\xda" + struct.pack(">HB", 8, 1) + bytes([1, 0, 1, 0, 0]),
    ]
)


# --- writing --------------------------------------------------------------------------------------------------------


def encode_rows(samples: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Entropy-coded rows one behind another, FF stuffed, and where each ends. samples: rows of WIDTH bytes."""
    rows = len(samples)
    diff = samples.astype(np.int16)
    diff[:, 1:] -= samples[:, :-1]
    diff[:, 0] -= 128
    at = diff + 255
    bits = _BITS[at]
    ends = np.cumsum(bits, axis=1)
    size = (ends[:, -1] + 7) >> 3
    first = np.concatenate(([0], np.cumsum(size)))
    start = ends - bits + (first[:-1] * 8)[:, None]
    shifted = _VALUE[at] << (24 - bits - (start & 7))
    where = (start >> 3).ravel()
    n = int(first[-1])
    out = np.zeros(n + 3)
    for k in range(3):
        out += np.bincount(where + k, weights=((shifted >> (16 - 8 * k)) & 255).ravel(), minlength=n + 3)[: n + 3]
    raw = out[:n].astype(np.uint8)
    pad = size * 8 - ends[:, -1]
    raw[first[1:] - 1] |= ((1 << pad) - 1).astype(np.uint8)  # a row's last byte fills up with ones
    full = raw == 255
    to = np.arange(n) + np.concatenate(([0], np.cumsum(full)))[:n]
    stuffed = np.zeros(n + int(full.sum()), np.uint8)
    stuffed[to] = raw
    shift = np.concatenate(([0], np.cumsum(full)))
    return stuffed.tobytes(), (first[1:] + shift[first[1:]]) if rows else first


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def _file(frames: list[bytes], payload_bytes: int) -> bytes:
    n, most = len(frames), max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, n, 0, 1, most, WIDTH, HEIGHT, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, n, most, 0, WIDTH * HEIGHT, 0, 0, WIDTH, HEIGHT)
    strf = struct.pack("<IiiHH4sIiiII", 40, WIDTH, HEIGHT, 1, 8, b"MJPG", WIDTH * HEIGHT, 0, 0, 0, 0)
    strl = b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf) + _chunk(b"strd", struct.pack("<Q", payload_bytes))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", strl))
    movi, index, at = [b"movi"], [], 4
    for f in frames:
        c = _chunk(b"00dc", f)
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(f)))
        movi.append(c)
        at += len(c)
    body = b"AVI " + hdrl + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index))
    return _chunk(b"RIFF", body)


def payload_of(text: str) -> bytes:
    """UTF-8, filled with bytes 0 to a positive multiple of 64."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % WIDTH or (0 if raw else WIDTH))


def write_many(payloads: list[bytes]) -> list[bytes]:
    """An AVI file of each payload: its bytes are the samples, row by row; the last frame is filled with zeros."""
    counts = [-(-len(p) // (WIDTH * HEIGHT)) for p in payloads]
    filled = b"".join(p + b"\0" * (c * WIDTH * HEIGHT - len(p)) for p, c in zip(payloads, counts, strict=True))
    coded, ends = encode_rows(np.frombuffer(filled, np.uint8).reshape(-1, WIDTH))
    ends = [0, *ends.tolist()]
    restarts = [b"\xff" + bytes([0xD0 + (k & 7)]) for k in range(HEIGHT - 1)] + [b"\xff\xd9"]
    out, row = [], 0
    for p, c in zip(payloads, counts, strict=True):
        frames = []
        for _ in range(c):
            parts = [_FRAME_HEAD]
            for k in range(HEIGHT):
                parts += (coded[ends[row] : ends[row + 1]], restarts[k])
                row += 1
            frames.append(b"".join(parts))
        out.append(_file(frames, len(p)))
    return out


# --- reading --------------------------------------------------------------------------------------------------------


def chunks(raw: bytes, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(name, start, end) of the chunks in a range; of a list, the name is its kind."""
    while at + 8 <= end:
        name, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        start = at + 8
        if start + size > end:
            raise ValueError("a chunk passes its parent's end")
        if name in (b"RIFF", b"LIST"):
            yield raw[start : start + 4], start + 4, start + size
        else:
            yield name, start, start + size
        at = start + size + (size & 1)


def parse_avi(raw: bytes) -> tuple[list[tuple[int, int]], int, float]:
    """Frame ranges by the index, payload bytes and frames a second."""
    kind, start, end = next(chunks(raw, 0, len(raw)), (b"", 0, 0))
    if kind != b"AVI ":
        raise ValueError("not an AVI file")
    movi, frames, payload, fps = None, [], 0, float(FPS)
    for name, a, b in chunks(raw, start, end):
        if name == b"hdrl":
            for sub, c, d in chunks(raw, a, b):
                if sub == b"avih":
                    fps = 1e6 / struct.unpack_from("<I", raw, c)[0]
                elif sub == b"strl":
                    payload = next((struct.unpack_from("<Q", raw, e)[0] for inner, e, _ in chunks(raw, c, d) if inner == b"strd"), 0)
        elif name == b"movi":
            movi = a - 4
        elif name == b"idx1":
            for name_, _, at, size in struct.iter_unpack("<4sIII", raw[a:b]):
                if name_ == b"00dc":
                    frames.append((movi + at + 8, movi + at + 8 + size))
    return frames, payload, fps


def parse_frame(raw: bytes, at: int, end: int) -> tuple[int, int, bytes, int]:
    """Height, width, DHT body and where the coded rows start."""
    if raw[at : at + 2] != b"\xff\xd8" or raw[end - 2 : end] != b"\xff\xd9":
        raise ValueError("not a JPEG frame")
    at += 2
    height = width = 0
    table = b""
    while True:
        marker, size = raw[at : at + 2], struct.unpack_from(">H", raw, at + 2)[0]
        if marker == b"\xff\xc3":
            height, width = struct.unpack_from(">HH", raw, at + 5)
        elif marker == b"\xff\xc4":
            table = raw[at + 4 : at + 2 + size]
        elif marker == b"\xff\xda":
            return height, width, table, at + 2 + size
        at += 2 + size


def decode_frames(coded: list[bytes], table: tuple[np.ndarray, np.ndarray], width: int, rows: int) -> np.ndarray:
    """Samples of `rows` rows, from the coded parts of frames with their end markers."""
    raw = np.frombuffer(b"".join(coded), np.uint8)
    mark = np.flatnonzero((raw[:-1] == 255) & (raw[1:] >= 0xD0) & (raw[1:] <= 0xD9))
    if len(mark) != rows:
        raise ValueError("restart intervals are missing")
    keep = np.ones(len(raw), bool)
    keep[1:][(raw[:-1] == 255) & (raw[1:] == 0)] = False  # stuffed bytes
    keep[mark] = keep[mark + 1] = False
    left = np.concatenate(([0], np.cumsum(keep)))
    starts = np.concatenate(([0], left[mark[:-1] + 2]))
    data = np.concatenate((raw[keep], np.zeros(4, np.uint8)))
    words = np.ndarray((len(data) - 3,), ">u4", data.data, 0, (1,)).astype(np.uint32)
    at = starts * 8
    out = np.zeros((width, rows), np.int16)
    diff, used = table
    mask, top = np.uint32((1 << WINDOW_BITS) - 1), 32 - WINDOW_BITS
    for k in range(width):
        peek = (words[at >> 3] >> (top - (at & 7)).astype(np.uint32)) & mask
        out[k] = diff[peek]
        at += used[peek]
    out[0] += 128
    return np.cumsum(out, axis=0, dtype=np.int16).astype(np.uint8).T


def read_many(files: list[bytes]) -> list[tuple[np.ndarray, int, float]]:
    """(samples by frame, payload bytes, frames a second) of each file; frames of one shape and table decode together."""
    parsed = [parse_avi(raw) for raw in files]
    groups: dict[tuple[int, int, bytes], list[tuple[int, int, bytes]]] = {}
    for f, (raw, (frames, _, _)) in enumerate(zip(files, parsed, strict=True)):
        for k, (a, b) in enumerate(frames):
            height, width, table, at = parse_frame(raw, a, b)
            groups.setdefault((height, width, table), []).append((f, k, raw[at:b]))
    out: list = [[None] * len(frames) for frames, _, _ in parsed]
    for (height, width, table), parts in groups.items():
        samples = decode_frames([p for _, _, p in parts], lookup_of(table), width, height * len(parts)).reshape(len(parts), height, width)
        for (f, k, _), s in zip(parts, samples, strict=True):
            out[f][k] = s
    return [(np.stack(s), payload, fps) for s, (_, payload, fps) in zip(out, parsed, strict=True)]


_lookups: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def lookup_of(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    if table not in _lookups:
        _lookups[table] = lookup(list(table[1:17]), list(table[17:]))
    return _lookups[table]


# --- shots ----------------------------------------------------------------------------------------------------------


def shots(frames: np.ndarray) -> list[tuple[int, int, float]]:
    """(first frame, end frame, difference at its start) of each shot.

    Histograms of neighbours are compared; the threshold follows the mean and deviation of the differences before.
    """
    n = len(frames)
    flat = frames.reshape(n, -1) >> 4
    hist = np.bincount((np.arange(n)[:, None] * BINS + flat).ravel(), minlength=n * BINS).reshape(n, BINS)
    moved = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2.0 * flat.shape[1])
    cuts, past = [(0, 0.0)], []
    for k, d in enumerate(moved.tolist(), 1):
        mean = sum(past) / len(past) if past else 0.0
        spread = (sum((x - mean) ** 2 for x in past) / len(past)) ** 0.5 if past else 0.0
        if d > max(LEAST, mean + DEVIATIONS * spread):
            cuts.append((k, d))
            past = []
        else:
            past = [*past[1 - HISTORY :], d]
    ends = [c for c, _ in cuts[1:]] + [n]
    return [(a, b, d) for (a, d), b in zip(cuts, ends, strict=True)]


# --- on tables ------------------------------------------------------------------------------------------------------


def _steps(sizes: list[int]) -> Iterator[tuple[int, int]]:
    a, held = 0, 0
    for k, n in enumerate(sizes):
        held += n
        if held >= STEP_BYTES:
            yield a, k + 1
            a, held = k + 1, 0
    if a < len(sizes):
        yield a, len(sizes)


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, media (binary): the AVI file of each text. Null is the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, texts = ids_and_texts(batch)
            payloads = [payload_of(t) for t in texts]
            n = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            for a, b in _steps([len(p) for p in payloads]):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(n[a:b], pa.int64()), pa.array(write_many(payloads[a:b]), pa.binary())], names=["id", "n_bytes", "media"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_bytes long, media binary")


def clips(media: DataFrame) -> DataFrame:
    """id, clip, start_ms, end_ms, difference: a row for each shot of each file."""
    kind = media.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(1).to_pylist()
            for a, b in _steps([len(f) for f in files]):
                at, rows = [], []
                for k, (frames, _, fps) in enumerate(read_many(files[a:b]), a):
                    for clip, (start, end, d) in enumerate(shots(frames)):
                        at.append(k)
                        rows.append((clip, round(1000 * start / fps), round(1000 * end / fps), d))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.float64()))]], names=["id", "clip", "start_ms", "end_ms", "difference"])

    return media.select("id", "media").mapInArrow(run, f"id {kind}, clip int, start_ms long, end_ms long, difference double")


def media_digests(media: DataFrame) -> DataFrame:
    """id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature: all read back from media.

    feature has the shots as start-end in ms, joined by commas. A row for each row of media; equal texts have equal files
    and so equal values, null ids stay, and the empty text is one block of zeros.
    """
    kind = media.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column(2).to_pylist()
            for a, b in _steps([len(f) for f in files]):
                rows = []
                for raw, (frames, payload, fps) in zip(files[a:b], read_many(files[a:b]), strict=True):
                    stored = frames.tobytes()[:payload]
                    feature = ",".join(f"{round(1000 * s / fps)}-{round(1000 * e / fps)}" for s, e, _ in shots(frames))
                    rows.append((payload, hashlib.sha256(stored).hexdigest(), zlib.crc32(stored[-64:]), len(raw), hashlib.sha256(raw).hexdigest(), feature))
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), *[pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]], names=["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.mapInArrow(run, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
