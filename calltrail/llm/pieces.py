"""SentencePiece files: exact merge encoding by backtracking, decoding, and count-only Viterbi.

Both encoders see a text as chunks between which no piece of the vocabulary reaches, so a chunk's result does not
depend on its neighbours and each worker computes a repeated chunk once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.llm.common import Memo, ids_and_texts, in_slices, numbered_words, worker_state

SPACE = "▁"
NO_MERGE = -1e8


class PieceVocabulary:
    """Pieces, scores and byte ids of a SentencePiece file, with an Aho-Corasick automaton over the normal pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(n)]
        self.control = {i for i in range(n) if model.is_control(i)}
        self.unknown = next((i for i in range(n) if model.is_unknown(i)), 0)
        self.byte_value = {i: int(self.pieces[i][1:-1], 16) for i in range(n) if model.is_byte(i)}
        self.byte_id = {b: i for i, b in self.byte_value.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i] and i not in self.byte_value}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        #: Unigram scores; the file's mark for "no merge makes it" (-1e9) is no probability and counts as just below the rest.
        regular = [s for s in self.score.values() if s > NO_MERGE]
        floor = min(regular) - 1.0
        self.unigram = {p: max(s, floor) for p, s in self.score.items()}
        self.unknown_cost = min(self.unigram.values()) - 10.0
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.singles = {p for p in self.ids if len(p) == 1}
        self.chunks = re.compile(self._chunk_pattern()).findall
        self.pair_ok = Memo(self._compatible, 250_000)
        self.self_ok = Memo(self._reaches_itself, 40_000)

    def _chunk_pattern(self) -> str:
        """Splits before each run of spaces, between letters and the marks that no piece joins to a letter, and around what no piece joins to anything."""
        pairs = {(p[i], p[i + 1]) for p in self.ids for i in range(len(p) - 1)}
        assert all(b != SPACE or a == SPACE for a, b in pairs), "a piece holds a space after its start"
        letters = r"[^\W\d_" + "".join(c for c in {c for p in self.ids for c in p} if c.isalnum() and not c.isalpha() and not c.isdecimal()) + "]"
        letter = re.compile(letters).match
        plain = [c for c in map(chr, range(128)) if not c.isalnum()]
        joined = {a for a, b in pairs if letter(b)} | {b for a, b in pairs if letter(a)}
        marks = "".join(re.escape(c) for c in plain if c not in joined)
        self.loose = "".join(c for c in ".,;:!?" if c not in joined)  # may be cut off behind a letter
        alone = "".join(re.escape(c) for c in plain if not any(c in p for p in pairs))
        if not alone:
            self.loose = ""
            return f"{SPACE}*[^{SPACE}]+|{SPACE}+"
        return rf"{SPACE}*{letters}++(?=[{marks}{SPACE}]|\Z)|{SPACE}*[{marks}]++(?={letters}|{SPACE}|\Z)|[{alone}]+|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"

    def split(self, text: str) -> list[str]:
        return self.chunks(SPACE + text.replace(" ", SPACE)) if text else []

    def merge(self, text: str) -> list[str]:
        """Merges the adjacent pair of the best score, leftmost first, until no pair is a piece."""
        parts, score = list(text), self.score.get
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, pair: tuple[str, str]) -> bool:
        return self.merge(pair[0] + pair[1]) == [pair[0], pair[1]]

    def _reaches_itself(self, piece: str) -> bool:
        return self.merge(piece) == [piece]

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk: runs of characters that are pieces by backtracking, other characters, which no merge crosses, as bytes."""
        if self.singles.issuperset(chunk):
            return self._backtrack(chunk)
        out: list[int] = []
        for known, run in groupby(chunk, self.singles.__contains__):
            out += self._backtrack("".join(run)) if known else [i for c in run for i in self.bytes_of(c)]
        return out

    def _backtrack(self, run: str) -> list[int]:
        """Backtracking over the longest matches; a bit per position remembers that no encoding passes through it."""
        ids, pair_ok, self_ok, n = self.ids, self.pair_ok, self.self_ok, len(run)
        starts: list[list[int]] = [[] for _ in run]
        for end, (length, _) in self.automaton.iter(run):
            starts[end - length + 1].append(length)  # ascending, as matches end in this order: the longest is last
        found: list[str] = []
        left: list[int] = []  # candidates not yet tried where each piece of found starts
        failed, pos, last, k = 0, 0, None, len(starts[0])
        while pos < n:
            lengths = starts[pos]
            while k:
                k -= 1
                end = pos + lengths[k]
                piece = run[pos:end]
                if not failed >> end & 1 and (self_ok[piece] if last is None else pair_ok[last, piece]):
                    found.append(piece)
                    left.append(k)
                    pos, last = end, piece
                    k = len(starts[end]) if end < n else 0
                    break
            else:
                if last is None:
                    raise ValueError(f"no encoding of {run!r}")
                failed |= 1 << pos
                pos -= len(found.pop())
                k, last = left.pop(), found[-1] if found else None
        return [ids[p] for p in found]

    def bytes_of(self, char: str) -> list[int]:
        if not self.byte_id:
            return [self.unknown]
        return [self.byte_id[b] for b in char.encode("utf-8", "surrogatepass")]

    def encode(self, text: str) -> list[int]:
        return [i for c in self.split(text) for i in self.encode_chunk(c)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the leading space that encoding adds."""
        return self.decode_parts(ids).removeprefix(SPACE).replace(SPACE, " ")

    def decode_parts(self, ids: list[int]) -> str:
        """Pieces as they are, bytes joined into characters."""
        out = bytearray()
        for i in ids:
            if i in self.byte_value:
                out.append(self.byte_value[i])
            elif i not in self.control:
                out += self.pieces[i].encode() if i != self.unknown else b" \xe2\x81\x87 "
        return out.decode("utf-8", "replace")

    def count_chunk(self, chunk: str) -> int:
        """Pieces on the best path by summed score.

        At equal sums the first candidate stays, which is the one that starts earliest. A character that is no piece
        costs 10 below the lowest score and counts as its bytes.
        """
        n = len(chunk)
        best: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        best[0] = 0.0
        ends: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, found in self.automaton.iter(chunk):
            ends[end].append(found)
        for end in range(1, n + 1):
            top, pieces = None, 0
            for length, i in ends[end - 1]:  # from the longest to the shortest
                s = best[end - length] + self.unigram[self.pieces[i]]
                if top is None or s > top:
                    top, pieces = s, count[end - length] + 1
            if chunk[end - 1] not in self.ids:
                s = best[end - 1] + self.unknown_cost
                if top is None or s > top:
                    top, pieces = s, count[end - 1] + (len(chunk[end - 1].encode("utf-8", "surrogatepass")) if self.byte_id else 1)
            best[end], count[end] = top, pieces
        return count[n]


def vocabulary(path: str) -> PieceVocabulary:
    """One for each Python worker, with its memos."""
    return worker_state(("pieces", path), lambda: PieceVocabulary(path))


class ByPart:
    """Results of texts from those of their parts: a worker computes a part once, and looks it up once for many texts.

    Parts start at single spaces and before loose marks. Texts with runs of spaces, outer spaces, the space mark itself or
    SPLIT are cut into chunks one by one.
    """

    SPLIT = "\x01"

    def __init__(self, v: PieceVocabulary, compute, limit: int):
        self.v, self.part = v, Memo(compute, limit)

    def cut(self, texts: list[str]) -> tuple[list[int], pa.Array, pa.DictionaryArray] | None:
        """(which texts, their parts as lists, as numbers of a dictionary) of texts that need no cutting one by one."""
        plain = [k for k, t in enumerate(texts) if t and "  " not in t and t[0] != " " != t[-1] and SPACE not in t and self.SPLIT not in t]
        if not plain:
            return None
        column = pc.replace_substring(pa.array([SPACE + texts[k] for k in plain], pa.large_string()), " ", self.SPLIT + SPACE)
        if self.v.loose:
            column = pc.replace_substring_regex(column, rf"([A-Za-zÀ-ÖØ-öø-ÿ])([{self.v.loose}]+)(\n|{self.SPLIT}|$)", rf"\1{self.SPLIT}\2\3")
        return plain, *numbered_words(column, self.SPLIT)


class TextCodec(ByPart):
    """Ids of texts, as decimals joined by commas, and the texts decoded from them, part by part.

    Only ids are kept. A part that does not decode to itself is never kept, and stands in `odd` while texts are worked on.
    """

    def __init__(self, v: PieceVocabulary, limit: int = 250_000):
        super().__init__(v, self._code, limit)
        self.odd: dict[str, str] = {}

    def _code(self, part: str) -> str:
        ids = [i for c in self.v.chunks(part) for i in self.v.encode_chunk(c)]
        decoded = self.v.decode_parts(ids)
        if decoded != part:
            self.odd[part] = decoded
        return ",".join(map(str, ids))

    def _forget_odd(self) -> None:
        self.part.forget(self.odd)
        self.odd = {}

    def __call__(self, text: str) -> tuple[str, str]:
        """(ids, decoded text)."""
        chunks = self.v.split(text)
        csv = ",".join(map(self.part.__getitem__, chunks))
        decoded = "".join([self.odd.get(c, c) for c in chunks] if self.odd else chunks).removeprefix(SPACE).replace(SPACE, " ")
        self._forget_odd()
        return csv, decoded

    def many(self, texts: list[str]) -> tuple[list[str], list[str]]:
        csv, back, rest = [""] * len(texts), list(texts), set(range(len(texts)))
        if (cut := self.cut(texts)) is not None:
            plain, split, coded = cut
            found = pa.array(list(map(self.part.__getitem__, coded.dictionary.to_pylist())), pa.large_string())
            if self.odd:  # a part decodes to something else
                self._forget_odd()
            else:
                joined = pc.binary_join(pa.ListArray.from_arrays(split.offsets, found.take(coded.indices)), pa.scalar(",", pa.large_string()))
                for k, c in zip(plain, joined.to_pylist(), strict=True):
                    csv[k] = c
                rest.difference_update(plain)
        for k in rest:
            csv[k], back[k] = self(texts[k])
        return csv, back


class Counter(ByPart):
    """Numbers of pieces of texts on their best paths."""

    def __init__(self, v: PieceVocabulary, limit: int = 700_000):
        super().__init__(v, lambda part: sum(map(v.count_chunk, v.chunks(part))), limit)

    def __call__(self, text: str) -> int:
        return sum(map(self.part.__getitem__, self.v.split(text)))

    def many(self, texts: list[str]) -> list[int]:
        out, rest = [0] * len(texts), set(range(len(texts)))
        if (cut := self.cut(texts)) is not None:
            plain, split, coded = cut
            found = np.array(list(map(self.part.__getitem__, coded.dictionary.to_pylist())), np.int64)[coded.indices.to_numpy()]
            for k, n in zip(plain, np.add.reduceat(found, split.offsets.to_numpy()[:-1]).tolist(), strict=True):
                out[k] = n
            rest.difference_update(plain)
        for k in rest:
            out[k] = self(texts[k])
        return out


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a text: id, ids (array of int), decoded. Null is the empty text, which has no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for batch in in_slices(batches):
            _, texts = ids_and_texts(batch)
            coded = [v.encode(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded, pa.list_(pa.int32())), pa.array([v.decode(c) for c in coded], pa.string())], names=["id", "ids", "decoded"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")


def encode_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digest form of encode_texts(), chunk results joined from the worker's memo: id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_state(("pieces", path, "codec"), lambda: TextCodec(PieceVocabulary(path)))
        sha = hashlib.sha256
        for batch in in_slices(batches):
            _, texts = ids_and_texts(batch)
            csv, back = codec.many(texts)
            n = [c.count(",") + 1 if c else 0 for c in csv]
            coded = [sha(c.encode()).hexdigest() for c in csv]
            decoded = [sha(t.encode("utf-8", "surrogatepass")).hexdigest() for t in back]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens by the best-scored segmentation. Null and empty texts have 0.

    Scores are summed exactly; the library sums in 32-bit floats and so may round on texts of thousands of pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_state(("pieces", path, "counter"), lambda: Counter(PieceVocabulary(path)))
        for batch in in_slices(batches):
            _, texts = ids_and_texts(batch)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.many(texts), pa.int64())], names=["id", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_tokens long")
