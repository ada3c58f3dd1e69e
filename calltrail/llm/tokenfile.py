"""Token ids in binary files: canonical length-limited Huffman codes from global counts.

A file is a run of blocks. A block holds the ids of whole documents in ascending doc_id order:

    "HTB1" | n_docs u32 | n_ids u32 | n_marks u32 | n_bytes u32 | ids of each document u32... | marks u32... | code bits

A mark is the bit offset of every STEP-th id, so that decoding may start at any of them. The code lengths (a byte an id)
stand in the file "codes" once for all files. Bits are written from the highest of each byte.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltrail.llm.blobs import BlobReader, BlobWriter
from calltrail.llm.common import discard, ids_and_texts, in_slices, materialize, new_path, numbered_words, worker_state

MAX_BITS = 16
STEP = 64
#: Ids in a block, more or less: a block ends with the document that passes it.
BLOCK_IDS = 1 << 18
END_ID = 1
#: Ids in one output file, more or less.
FILE_IDS = 1 << 23
# Letters of Latin-1 are composed, and their lower case is one letter of Latin-1 each. The tokenizer parts runs of
# letters, single digits and runs of marks; "'" may start a part of its own, and "<" a special token.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[{_LETTERS}0-9!-&(-/:;=-@[-`{{-~]+").fullmatch
_PARTS = re.compile(rf"[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+").findall
_MARK_BEHIND = rf"([{_LETTERS}])([.,])( |$)"


# --- ids of texts ---------------------------------------------------------------------------------------------------


class WordIds:
    """Ids of texts from their words' ids: the tokenizer drops white space and never joins across it.

    A batch's texts are split and numbered by word at once. Words that a worker has not seen are encoded together, one
    library call for many; all words' ids stand in one array that grows, and starts anew when it holds `limit` words.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        pieces = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(pieces.values()) + 1, bool)
        self.ends[[i for p, i in pieces.items() if p.endswith("</w>")]] = True
        self.limit = limit
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.at = np.zeros(1, np.int64)  # where each word's ids start, and the end of the last
        self.ids = np.zeros(0, np.uint32)

    def _one_by_one(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for f in found for i in f], np.uint32), np.array([len(f) for f in found], np.int64)

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each word, from one text of all words: each part ends with a piece that says so."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends[ids]) + 1
        parts = np.cumsum([1 if w.isalpha() else len(_PARTS(w)) for w in words])
        if parts[-1] != len(last):
            return self._one_by_one(words)
        return ids, np.diff(last[parts - 1], prepend=0)

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if _PLAIN(w)]
        other = [w for w in words if not _PLAIN(w)]
        ids, sizes = [self.ids], []
        for some, encode in [(plain[k : k + 20_000], self._joined) for k in range(0, len(plain), 20_000)] + [(other, self._one_by_one)] * bool(other):
            found, size = encode(some)
            ids.append(found)
            sizes.append(size)
        self.rows.update(zip(plain + other, range(len(self.rows), len(self.rows) + len(words)), strict=True))
        self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(np.concatenate(sizes))))
        self.ids = np.concatenate(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        column = pa.array([folded(t) for t in texts], pa.large_string())
        column = pc.replace_substring(column, "\n", " ")
        column = pc.replace_substring_regex(column, _MARK_BEHIND, r"\1 \2\3")
        split, coded = numbered_words(column)
        words = coded.dictionary.to_pylist()
        known = list(map(self.rows.get, words))
        if None in known:
            new = [w for w, k in zip(words, known, strict=True) if k is None]
            if len(self.rows) + len(new) > self.limit:
                self._forget()
                new = words
            self._learn(new)
            known = list(map(self.rows.__getitem__, words))
        rows = np.array(known, np.int64)[coded.indices.to_numpy()]
        first, size = self.at[rows], self.at[rows + 1] - self.at[rows]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.arange(total) + np.repeat(first - (ends - size), size)]
        of_text = np.concatenate(([0], ends))[split.offsets.to_numpy()]
        return ids, np.diff(of_text)


def folded(text: str) -> str:
    """In lower case, as the tokenizer has it anyway, where that is sure to change no ids: Latin-1 without special tokens."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text if "<|" in text else text.lower()


def encode_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """id, n, ids (binary): ids with the end id behind them, 2 bytes each where the vocabulary allows, else 4."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_state(("words", path), lambda: WordIds(path))
        kind = np.dtype("<u2" if max(words.size, end_id + 1) <= 1 << 16 else "<u4")
        for batch in in_slices(batches):
            _, texts = ids_and_texts(batch)
            ids, n = words.encode(texts)
            whole = np.full(len(ids) + len(n), end_id, kind)
            whole[np.arange(len(ids)) + np.repeat(np.arange(len(n)), n)] = ids
            offsets = np.concatenate(([0], np.cumsum(n + 1))) * kind.itemsize
            binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(whole)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n + 1, pa.int64()), binary], names=["id", "n", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n long, ids binary")


# --- the code -------------------------------------------------------------------------------------------------------


def limited_lengths(counts: dict[int, int], most: int = MAX_BITS) -> dict[int, int]:
    """Lengths of an optimal prefix code of at most `most` bits: at each level, pairs of the cheapest packages go up."""
    if len(counts) < 2:
        return dict.fromkeys(counts, 1)
    most = max(most, int(np.ceil(np.log2(len(counts)))))
    names = sorted(counts, key=lambda x: (counts[x], x))
    weights = np.array([counts[x] for x in names], np.int64)
    # A level is kept as which of its items are leaves: the cheapest come first, so counts say which leaves it takes.
    levels = []
    packages = np.zeros(0, np.int64)
    for _ in range(most):
        merged = np.concatenate((weights, packages))
        order = np.argsort(merged, kind="stable")
        levels.append(order < len(weights))
        merged = merged[order]
        half = len(merged) // 2
        packages = merged[: 2 * half : 2] + merged[1 : 2 * half : 2]
    length = np.zeros(len(names), np.int64)
    take = 2 * (len(names) - 1)
    for is_leaf in reversed(levels):
        n = int(is_leaf[:take].sum())
        length[:n] += 1
        take = 2 * (take - n)
    return {x: int(n) for x, n in zip(names, length, strict=True)}


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes ascend with (length, id); ids of length 0 have none."""
    codes = np.zeros(len(lengths), np.uint32)
    code, last = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        n = int(lengths[i])
        if n:
            code <<= n - last
            codes[i], last = code, n
            code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """By the next `bits` bits: the id and its length."""
    bits = int(lengths.max(initial=1))
    order = [i for i in np.lexsort((np.arange(len(lengths)), lengths)).tolist() if lengths[i]]
    spans = np.array([1 << (bits - int(lengths[i])) for i in order], np.int64)
    ids = np.repeat(np.array(order, np.uint32), spans)
    sizes = np.repeat(lengths[order].astype(np.uint8), spans)
    rest = (1 << bits) - len(ids)
    return np.concatenate((ids, np.zeros(rest, np.uint32))), np.concatenate((sizes, np.ones(rest, np.uint8))), bits


def pack_block(counts: list[int], ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> bytes:
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1]) if len(ends) else 0
    n_bytes = (total + 7) // 8
    # A code and its offset in a byte span at most 32 bits: four byte sums, of bits that never meet.
    shifted = codes[ids].astype(np.int64) << (32 - size - (starts & 7))
    first = starts >> 3
    out = np.zeros(n_bytes + 4, np.float64)
    for k in range(4):
        out += np.bincount(first + k, weights=(shifted >> (24 - 8 * k)) & 255, minlength=len(out))[: len(out)]
    marks = starts[::STEP].astype("<u4")
    head = np.array([len(counts), len(ids), len(marks), n_bytes], "<u4")
    return b"".join([b"HTB1", head.tobytes(), np.array(counts, "<u4").tobytes(), marks.tobytes(), out[:n_bytes].astype(np.uint8).tobytes()])


def unpack_block(raw: bytes, table: tuple[np.ndarray, np.ndarray, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each document and all ids. All marks decode side by side, an id of each at a time."""
    if raw[:4] != b"HTB1":
        raise ValueError("not a block")
    n_docs, n_ids, n_marks, n_bytes = np.frombuffer(raw, "<u4", 4, 4).tolist()
    counts = np.frombuffer(raw, "<u4", n_docs, 20)
    at = np.frombuffer(raw, "<u4", n_marks, 20 + 4 * n_docs).astype(np.int64)
    bits = np.frombuffer(raw, np.uint8, n_bytes, 20 + 4 * (n_docs + n_marks))
    padded = np.concatenate((bits, np.zeros(8, np.uint8)))
    words = np.ndarray((len(padded) - 3,), ">u4", padded.data, 0, (1,)).astype(np.uint32)  # 32 bits from each byte on
    names, sizes, width = table
    out = np.zeros((STEP, n_marks), np.uint32)
    last = n_ids - STEP * (n_marks - 1) if n_marks else 0
    for k in range(STEP):
        live = n_marks if k < last else n_marks - 1
        if live <= 0:
            break
        here = at[:live]
        peek = (words[here >> 3] >> (32 - width - (here & 7)).astype(np.uint32)) & np.uint32((1 << width) - 1)
        out[k, :live] = names[peek]
        at[:live] += sizes[peek]
    return counts, out.T.ravel()[:n_ids] if last == STEP or not n_marks else np.concatenate((out.T[:-1].ravel(), out[:last, -1]))


# --- files ----------------------------------------------------------------------------------------------------------


def count_ids(coded: DataFrame, wide: int) -> dict[int, int]:
    """How often each id occurs in all documents. What reaches the driver has a row for an id of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            got = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), f"<u{wide}"))
            if len(got) > len(total):
                total, got = got, total
            total[: len(got)] += got
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["token", "n"])

    found = coded.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r["token"]: r["n"] for r in found}


def write_token_files(coded: DataFrame, folder: str, wide: int, lengths: np.ndarray, file_ids: int = FILE_IDS) -> DataFrame:
    """One row a block: shard, block, file, at, size, first ids and counts. Blocks ascend by id over shards.

    coded goes to shards by ranges of id; rows of one id stay in one shard. Null ids come first.
    """
    spark = coded.sparkSession
    shared = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))
    n = coded.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-n // file_ids), min(spark.sparkContext.defaultParallelism, -(-n // (file_ids // 16))))
    id_type = coded.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        lengths, codes = shared.value
        shard = TaskContext.get().partitionId()
        out, rows, ids, counts, parts, held = None, [], [], [], [], 0

        def flush() -> None:
            nonlocal out, ids, counts, parts, held
            if counts:
                out = out or BlobWriter(folder, ".htb")
                raw = pack_block(counts, np.frombuffer(b"".join(parts), f"<u{wide}").astype(np.int64), lengths, codes)
                rows.append((shard, len(rows), out.name, out.tell(), len(raw), ids, sum(counts)))
                out.write([raw])
            ids, counts, parts, held = [], [], [], 0

        for batch in batches:
            for i, n, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids.append(i)
                counts.append(n)
                parts.append(raw)
                held += n
                if held >= BLOCK_IDS:
                    flush()
        flush()
        if out:
            out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.list_(id_arrow), pa.int64()))],
            names=["shard", "block", "file", "at", "size", "ids", "n"],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(coded.schema["id"].dataType)
    sorted_ = coded.select("id", "n", "ids").repartitionByRange(shards, "id").sortWithinPartitions("id", "n", "ids")
    return sorted_.mapInArrow(run, f"shard int, block int, file string, at long, size long, ids array<{id_type}>, n long")


def read_token_files(blocks: DataFrame, folder: str, id_type) -> DataFrame:
    """id, start, n_tokens, ids_crc32 from the files: each block is read and decoded on its own.

    Starts are sums over blocks before it, of which the manifest has a row each and shards one.
    """
    from pyspark.sql import Window
    from pyspark.sql.pandas.types import to_arrow_type

    id_arrow = to_arrow_type(id_type)
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n"))
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("before"))
    inner = Window.partitionBy("shard").orderBy("block")
    placed = blocks.withColumn("inside", F.sum("n").over(inner) - F.col("n")).join(before, "shard").select("file", "at", "size", "ids", (F.col("inside") + F.col("before")).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = BlobReader(folder)
        lengths = np.frombuffer(reader.read("codes", 0, -1), np.uint8)
        table = decode_table(lengths)
        for batch in batches:
            for file, at, size, ids, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts, tokens = unpack_block(reader.read(file, at, size), table)
                raw = memoryview(tokens.astype("<u4").tobytes())
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_arrow), pa.array(start + starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    spread = placed.repartition(max(1, placed.sparkSession.sparkContext.defaultParallelism), "file", "at")
    return spread.mapInArrow(run, f"id {id_type.simpleString()}, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes docs, writes the files, reads them back: id, start, n_tokens, ids_crc32, one row for each row of docs.

    Null and empty texts have the end id alone. Rows of one id go by their number of ids, then by the
    ids; null ids come first.
    """
    size = WordIds(path, 0).size
    wide = 2 if max(size, END_ID + 1) <= 1 << 16 else 4
    coded = materialize(encode_ids(docs, path, id_col, text_col), "ids")
    counts = count_ids(coded, wide)
    lengths = np.zeros(max(size, END_ID + 1, *(x + 1 for x in counts)) if counts else 1, np.uint8)
    for x, n in limited_lengths(counts).items():
        lengths[x] = n
    folder = new_path(spark, "tokens")
    first = BlobWriter(folder, "")
    first.write([lengths.tobytes()])
    first.close()
    first.system.move(f"{_path(folder)}/{first.name}", f"{_path(folder)}/codes")
    blocks = materialize(write_token_files(coded, folder, wide, lengths), "blocks")
    discard(coded)
    return read_token_files(blocks, folder, docs.schema[id_col].dataType)


def _path(folder: str) -> str:
    from calltrail.llm.blobs import _open, uri_of

    return _open(uri_of(folder))[1]
