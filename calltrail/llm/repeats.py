"""Repeated byte strings: Burrows-Wheeler transforms of shards, merged by iterative interleave refinement.

A window is a 200-byte string of a text. Each window has a key, the smallest hash of its 64-byte grams, so equal windows
have equal keys and meet in one place. Windows next to each other with one smallest gram form a run; a run's snippet is
the bytes of its windows. Only runs whose key occurs elsewhere go on, each snippet once with a mark whether it repeats.
The snippets of a key with more than GROUP of them (texts around one passage) are split into windows, keyed by a hash of
all their bytes, of which those go on whose hash occurs twice. So no key is too large for a task.

Where snippets meet, they are dealt to shards, and each shard gets its transform: the order of its suffixes, the byte
before each, and the place of the suffix that starts with that byte. The interleave of the shards' windows starts as one
interval at their ends and is refined by stable counting sorts of the bytes that the transforms give, from the end of a
window to its start. Windows part in the round of their common length, and intervals that are left after 200 bytes hold
the repeated windows; what repeats within a shard is read off its own order, and an interval of nothing else leaves at
once. The shards' texts are not looked at again, and no merged suffix is sorted anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltrail.llm import bloom
from calltrail.llm.common import discard, in_slices, materialize

WINDOW, GRAM = 200, 64
#: Bytes of texts that one vectorised step takes; longer texts go in overlapping pieces.
PIECE = 1 << 18
#: Bytes of snippets in one refinement, more or less: it ends with a key.
BLOCK = 6 << 20
#: Snippets of one key beyond which its windows take keys of their own.
GROUP = 1000
#: Shards of snippets in one block.
SHARDS = 4

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]
_POS = np.uint64((1 << 20) - 1)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the 64 bytes from each place on, by joining hashes of 8, 16 and 32 bytes. raw: 64 bytes at least."""
    n = len(raw)
    h = np.ndarray((n - 7,), "<u8", raw.data, 0, (1,)) * _C[0]
    h ^= h >> np.uint64(32)
    for width, c, shift in ((8, _C[1], 29), (16, _C[2], 31), (32, _C[3], 30)):
        h = h[:-width] * c + h[width:]
        h ^= h >> np.uint64(shift)
    h *= _C[4]
    h ^= h >> np.uint64(33)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the next `width` values, from minima to the left and right within blocks of that width."""
    n = len(x) - width + 1
    padded = np.concatenate((x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, width)
    right = np.minimum.accumulate(padded, axis=1).ravel()
    left = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(left[:n], right[width - 1 : width - 1 + n])


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """(bytes, [(text, its place there, bytes)]): short texts together, long ones cut so that each window is in one piece."""
    held, parts, size = [], [], 0
    for t, raw in enumerate(texts):
        if len(raw) < WINDOW:
            continue
        for at in range(0, len(raw) - WINDOW + 1, PIECE):
            part = raw[at : at + PIECE + WINDOW - 1]
            if size and size + len(part) > PIECE:
                yield b"".join(held), parts
                held, parts, size = [], [], 0
            held.append(part)
            parts.append((t, at, size))
            size += len(part)
    if size:
        yield b"".join(held), parts


def runs(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, start, windows, key) of all runs, piece by piece. Texts below 200 bytes have none."""
    for raw, parts in _pieces(texts):
        buffer = np.frombuffer(raw, np.uint8)
        h = gram_hashes(buffer)
        marked = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
        least = sliding_min(marked, WINDOW - GRAM + 1)
        begin = np.array([p for _, _, p in parts])
        last = np.concatenate((begin[1:], [len(raw)])) - WINDOW + 1  # windows of a text start before it
        change = np.flatnonzero(least[1:] != least[:-1]) + 1
        edges = np.unique(np.concatenate((begin, last, change, [len(least)])))
        edges = edges[edges <= len(least)]
        start, size = edges[:-1], np.diff(edges)
        owner = np.searchsorted(begin, start, side="right") - 1
        inside = start < last[owner]
        start, size, owner = start[inside], size[inside], owner[inside]
        text = np.array([t for t, _, _ in parts])[owner]
        at = np.array([a for _, a, _ in parts])[owner] + start - begin[owner]
        yield text, at, size, h[(least[start] & _POS).astype(np.int64)].view(np.int64)


def _bytes(batch: pa.RecordBatch) -> tuple[list[bytes], list[bytes]]:
    return batch.column(0).to_pylist(), [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]


def run_table(own: DataFrame) -> DataFrame:
    """digest, text and the runs of each text: start, windows and key, as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            _, texts = _bytes(batch)
            found = [*runs(texts)]
            text, start, size, key = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(4))
            at = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, t)) for x, t in ((start, pa.int64()), (size, pa.int32()), (key, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), *lists], names=["digest", "text", "start", "windows", "key"])

    return own.select("digest", "text").mapInArrow(run, "digest binary, text binary, start array<long>, windows array<int>, key array<long>")


def repeated_keys(table: DataFrame) -> DataFrame:
    """key: those with runs at two places. One row a key and task leaves the map side."""
    runs_ = table.select("digest", F.explode(F.arrays_zip("start", "key")).alias("r")).select(F.col("r.key").alias("key"), F.xxhash64("digest", "r.start").alias("name"))
    return runs_.groupBy("key").agg(F.min("name").alias("a"), F.max("name").alias("b")).where("a <> b").select("key")


_SNIPPETS = "key long, digest binary, start long, windows int, snippet binary, mark binary"


def snippets(table: DataFrame, keys: DataFrame) -> DataFrame:
    """Runs with a repeated key. Keys go to the scan as a Bloom filter while it has its bound, else they are joined."""
    n = keys.count()
    found = bloom.build(keys, "key", n)
    shared = table.sparkSession.sparkContext.broadcast(found) if found is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            digests, texts = _bytes(batch)
            start, size, key = (batch.column(k).flatten().to_numpy() for k in (2, 3, 4))
            text = np.repeat(np.arange(len(texts)), np.diff(batch.column(2).offsets.to_numpy()))
            if shared is not None:
                keep = shared.value(np.ascontiguousarray(key))
                text, start, size, key = text[keep], start[keep], size[keep], key[keep]
            cut = [texts[t][a : a + k + WINDOW - 1] for t, a, k in zip(text.tolist(), start.tolist(), size.tolist(), strict=True)]
            marks = pa.array([xxhash.xxh3_128_digest(c) for c in cut], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array([digests[t] for t in text.tolist()], pa.binary()), pa.array(start, pa.int64()), pa.array(size, pa.int32()), pa.array(cut, pa.binary()), marks], names=["key", "digest", "start", "windows", "snippet", "mark"])

    out = table.mapInArrow(run, _SNIPPETS)
    return out if found is not None else out.join(keys, "key", "left_semi")


def split_snippets(hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(parts, links): windows of snippets as snippets of their own (key, mark, windows, snippet, twice), of those whose
    hash occurs twice, and where each stands (mark, parent, start). hot: mark, snippet, windows, twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, size=1 << 18):
            marks, texts = _bytes(batch)
            n = batch.column(2).to_numpy().astype(np.int64)
            h = gram_hashes(np.frombuffer(b"".join(texts), np.uint8))
            first = np.cumsum([0, *map(len, texts)])[:-1]
            inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(first, n) + inside
            key = h[at]
            for step in (GRAM, 2 * GRAM, WINDOW - GRAM):  # four grams hold all bytes of a window
                key = key * _C[1] + h[at + step]
                key ^= key >> np.uint64(29)
            twice = np.array(batch.column(3).to_pylist(), bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(marks, object)[np.repeat(np.arange(len(n)), n)], pa.binary()), pa.array(inside, pa.int64()), pa.array(key.view(np.int64)), pa.array(1 + np.repeat(twice, n).astype(np.int64))], names=["parent", "start", "key", "times"]
            )

    windows = materialize(hot.select("mark", "snippet", "windows", "twice").mapInArrow(run, "parent binary, start long, key long, times long"), "hot-windows")
    more = windows.groupBy("key").agg(F.sum("times").alias("n")).where("n > 1").select("key")
    kept = windows.join(more, "key").groupBy("parent").agg(F.collect_list(F.struct("key", "start", "times")).alias("w"))  # as many as a snippet has windows
    rows = kept.join(hot.select(F.col("mark").alias("parent"), F.col("snippet").alias("whole")), "parent").select("parent", "whole", F.explode("w").alias("w"))
    bytes_ = F.substring("whole", F.col("w.start").cast("int") + 1, F.lit(WINDOW))
    rows = materialize(rows.select("parent", "w.start", "w.key", "w.times", bytes_.alias("snippet")).withColumn("mark", F.unhex(F.substring(F.sha2("snippet", 256), 1, 32))), "parts")
    parts = rows.groupBy("key", "mark", "snippet").agg((F.sum("times") > 1).alias("twice")).withColumn("windows", F.lit(1))
    return parts, rows.select("mark", "parent", "start")


# --- transforms and their merge -------------------------------------------------------------------------------------


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of values, and their order."""
    order = np.argsort(keys)
    ordered = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.concatenate(([0], ordered[1:] != ordered[:-1])))
    return rank, order


def transform(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, symbol, back, same) of a shard's bytes, with an end byte behind them.

    place: rank of the suffix that starts at each byte, by its first 200 bytes; symbol and back, by rank: the byte before
    the suffix, and the rank of the suffix that starts with it; same, by start: a number that equal 200 bytes share.
    """
    n = len(raw) + 1
    padded = np.concatenate((raw, np.zeros(9, np.uint8)))
    rank, order = _ranks(np.ndarray((n,), ">u8", padded.data, 0, (1,)).astype(np.uint64))
    for ahead in (8, 16, 32, 64, WINDOW - 128):
        if rank[order[-1]] == n - 1:
            break  # all suffixes differ already
        rest = np.zeros(n, np.int64)
        rest[: n - ahead] = rank[ahead:] + 1
        rank, order = _ranks(rank << 32 | rest)
    place = np.empty(n, np.int32)
    place[order] = np.arange(n, dtype=np.int32)
    return place, padded[order - 1], place[order - 1], rank


def interleave(shards: list[tuple[np.ndarray, np.ndarray]], known: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Merges shards' transforms as far as their windows need it: (repeated, common) of each shard's windows.

    shards: bytes, and where windows start. known: windows that are repeated already. common: the length that a window
    has in common with others, from its end, when it parts from them or its interval is decided; two bytes a round.
    """
    symbols, backs, ends, repeated, base = [], [], [], [], 0
    for (raw, starts), seen in zip(shards, known, strict=True):
        place, symbol, back, same = transform(raw)
        own = same[starts]
        repeated.append(seen | (np.bincount(own, minlength=1)[own] > 1))
        symbols.append(symbol)
        backs.append(back + np.int32(base))
        ends.append(place[starts + WINDOW] + np.int32(base))
        base += len(place)
    symbol, back = np.concatenate(symbols), np.concatenate(backs)
    pair = symbol[back].astype(np.uint16) << np.uint16(8) | symbol  # two steps of a walk at once
    back = back[back]
    sure, at = np.concatenate(repeated), np.concatenate(ends)
    common = np.zeros(len(at), np.int16)
    row = np.arange(len(at))
    interval, settled = np.zeros(len(row), np.int32), sure.copy()
    for depth in range(2, WINDOW + 1, 2):
        if not len(row):
            break
        symbol = pair[at]
        order = np.argsort(symbol, kind="stable")
        symbol, interval, row, settled, at = symbol[order], interval[order], row[order], settled[order], back[at[order]]
        new = np.concatenate(([True], (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])))
        begin = np.flatnonzero(new)
        size = np.diff(np.concatenate((begin, [len(row)])))
        open_ = (size > 1) & ~np.logical_and.reduceat(settled, begin)  # of one window, or of repeated ones: decided
        keep = np.repeat(open_, size)
        common[row[keep]] = depth
        interval = np.repeat(np.cumsum(open_).astype(np.int32), size)[keep]
        row, at, settled = row[keep], at[keep], settled[keep]
    sure[row] = True
    cuts = np.cumsum([len(s) for _, s in shards])[:-1]
    return np.split(sure, cuts), np.split(common, cuts)


def refine(snips: list[bytes], sizes: np.ndarray, keys: np.ndarray, twice: np.ndarray) -> list[list[tuple[int, int]]]:
    """Ranges of repeated windows of each snippet. twice: the snippet itself stands at two places. keys: ascending."""
    alone = np.ones(len(snips), bool)  # the only snippet of its key meets no other
    same = keys[1:] == keys[:-1]
    alone[1:][same] = alone[:-1][same] = False
    shards, known, members = [], [], []
    for k in range(SHARDS):
        own = [i for i in range(k, len(snips), SHARDS) if not alone[i]]
        if own:
            first = np.cumsum([0, *(len(snips[i]) for i in own)])[:-1]
            size = sizes[own]
            before = np.cumsum(size) - size
            starts = np.repeat(first - before, size) + np.arange(int(size.sum()))
            shards.append((np.frombuffer(b"".join([snips[i] for i in own]), np.uint8), starts))
            known.append(np.repeat(twice[own], size))
            members.append((own, before))
    found = interleave(shards, known)[0] if shards else []
    out: list[list[tuple[int, int]]] = [[(0, int(n))] if t else [] for n, t in zip(sizes.tolist(), twice.tolist(), strict=True)]
    for (own, before), flags in zip(members, found, strict=True):
        for i, at, n in zip(own, before.tolist(), sizes[own].tolist(), strict=True):
            part = flags[at : at + n]
            if part.all():
                out[i] = [(0, n)]
            elif part.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([False], part, [False])).astype(np.int8))).tolist()
                out[i] = list(zip(edge[::2], edge[1::2], strict=True))
    return out


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by key, as tables that end with a key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) < BLOCK:
            continue
        whole = pa.Table.from_batches(held)
        key = whole.column("key").to_numpy()
        end = int(np.searchsorted(key, key[-1], side="left"))  # the last key may go on
        if end:
            yield whole.slice(0, end)
            held = pa.Table.from_pylist(whole.slice(end).to_pylist(), schema=whole.schema).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def refined(distinct: DataFrame) -> DataFrame:
    """mark, ranges (of windows) of snippets with a repeated window. distinct: key, snippet, windows, mark, twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _cut_blocks(batches):
            if not whole.num_rows:
                continue
            found = refine(whole.column("snippet").to_pylist(), whole.column("windows").to_numpy().astype(np.int64), whole.column("key").to_numpy(), np.array(whole.column("twice").to_pylist(), bool))
            keep = [k for k, r in enumerate(found) if r]
            yield pa.RecordBatch.from_arrays(
                [whole.column("mark").take(pa.array(keep, pa.int64())).combine_chunks(), pa.array([[{"a": a, "b": b} for a, b in found[k]] for k in keep], _RANGES)],
                names=["mark", "ranges"],
            )

    return distinct.select("key", "snippet", "windows", "mark", "twice").repartition("key").sortWithinPartitions("key").mapInArrow(run, "mark binary, ranges array<struct<a:long,b:long>>")


def repeated_windows(distinct: DataFrame) -> DataFrame:
    """mark, ranges of snippets with a repeated window, in several rows where a snippet was split."""
    large = materialize(distinct.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("key"), "large-keys")
    if large.isEmpty():
        return refined(distinct)
    parts, links = split_snippets(materialize(distinct.join(large, "key", "left_semi"), "large"))
    found = links.join(refined(parts), "mark").groupBy(F.col("parent").alias("mark")).agg(F.transform(F.array_sort(F.collect_list("start")), lambda k: F.struct(k.alias("a"), (k + 1).alias("b"))).alias("ranges"))
    return refined(distinct.join(large, "key", "left_anti")).unionByName(found)


_RANGES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in spans)]
    starts = [*(a for a, _ in spans), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends, starts, strict=True))


def repeat_spans(own: DataFrame) -> DataFrame:
    """digest, spans (of bytes, may overlap) of distinct texts with repeated windows. own: digest, text."""
    table = materialize(run_table(own), "runs")
    keys = materialize(repeated_keys(table), "keys")
    found = materialize(snippets(table, keys), "snippets")
    discard(table, keys)
    name = F.xxhash64("digest", "start")
    distinct = materialize(found.groupBy("key", "mark", "windows", "snippet").agg((F.min(name) != F.max(name)).alias("twice")), "distinct-snippets")
    windows = materialize(repeated_windows(distinct), "all-windows")
    discard(distinct)
    places = found.select("mark", "digest", "start").distinct().join(windows, "mark")
    spans = F.transform("ranges", lambda r: F.struct((F.col("start") + r.a).alias("a"), (F.col("start") + r.b + (WINDOW - 1)).alias("b")))
    return places.select("digest", spans.alias("spans")).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256, kept (text's bytes; null where all or none are kept): a row for each row of docs.

    Null is the empty text. A text of 200 bytes or more that stands in two rows goes whole. Texts below that never lose
    a byte. Rows without repeats never move: their digest comes from the scan.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    sha = F.sha2(text, 256)
    own = docs.select(F.col(id_col).alias("id"), text.alias("text"), sha.alias("sha")).withColumn("digest", F.unhex(F.substring("sha", 1, 32)))
    light = own.select("id", "sha", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    copied = light.where(F.col("n_bytes") >= WINDOW).groupBy("digest", "n_bytes").agg(F.count("*").alias("n")).where("n > 1").select("digest", "n_bytes")
    spans = repeat_spans(own).join(copied.select("digest"), "digest", "left_anti")
    spans = materialize(spans, "spans")
    key = F.xxhash64("digest")
    filter_ = bloom.build(spans.select(key.alias("key")), "key", spans.count())
    texts = own.select("digest", "text")
    if filter_ is not None:
        shared = spark.sparkContext.broadcast(filter_)

        texts = texts.where(_likely(shared)(F.xxhash64("digest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, raws = _bytes(batch)
            rows = []
            for digest, raw, found in zip(digests, raws, batch.column(2).to_pylist(), strict=True):
                at = merged([(s["a"], s["b"]) for s in found])
                kept = without(raw, at)
                rows.append((digest, len(raw) - len(kept), len(at), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["digest", "n_removed", "n_spans", "kept_sha256", "kept"])

    cut = texts.join(spans, "digest").mapInArrow(run, "digest binary, n_removed long, n_spans long, kept_sha256 string, kept binary")
    gone = copied.select("digest", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.sha2(F.lit(""), 256).alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"))
    status = cut.unionByName(gone)
    out = light.join(status, "digest", "left")
    zero = F.lit(0).cast("long")
    return out.select("id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept")


def _likely(shared: Broadcast):
    @F.pandas_udf("boolean")
    def likely(keys: pd.Series) -> pd.Series:
        return pd.Series(shared.value(keys.to_numpy()))

    return likely
