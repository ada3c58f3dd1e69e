"""Benchmark decontamination: a generalised suffix automaton of test items, streamed over training words.

The automaton is over words of all items. For each document word the length of the longest suffix that is part of an
item is carried along; wherever it reaches the window length, that window is an occurrence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltrail.llm.common import ids_and_texts, in_slices, materialize, unused

#: Words: lower-cased A-Z, digits and every byte of a non-ASCII character; all other ASCII separates.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TO_WORDS = bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in _LOWER)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WINDOW = 10
#: Words of items in one automaton (some 400 MB of a process); more items than that are matched in several passes.
MAX_WORDS = 400_000


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class ItemAutomaton:
    """Suffix automaton of the items' word sequences, with the items in which each state's strings occur."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                coded.append((name, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        self.items: list[set[str | None]] = [set() for _ in self.next]
        self.short: dict[int, list[tuple[int, str | None]]] = {}
        self._name(coded)
        #: The nearest state at or above each, by suffix links, at which a short item ends; 0 for none.
        self.near = [0] * len(self.next)
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.near[v] = v if v in self.short else self.near[self.link[v]]
        self.least = min([window, *(len(ids) for _, ids in coded)], default=window)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = self._state({}, -1, length[last] + 1)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _state(self, nxt: dict[int, int], link: int, length: int) -> int:
        self.next.append(nxt)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        """Splits the shorter strings of q off into a state of their own."""
        copy = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _name(self, coded: list[tuple[str, list[int]]]) -> None:
        """Items of states that hold a whole window; items shorter than a window by the state of their whole text."""
        for name, ids in coded:
            state = 0
            for w in ids:
                state = self.next[state][w]
                v = state
                while v > 0 and self.length[v] >= self.window and name not in self.items[v]:
                    self.items[v].add(name)
                    v = self.link[v]
            if len(ids) < self.window:
                self.short.setdefault(state, []).append((len(ids), name))

    def occurrences(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Hit spans of words, ascending and merged, and the items with an occurring window. ids: -1 is no item's word."""
        known = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        spans: list[list[int]] = []
        found: set[str | None] = set()
        nxt, link, length, near, window = self.next, self.link, self.length, self.near, self.window
        for a, b in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
            if b - a < self.least:
                continue
            state, n = 0, 0
            for i, w in enumerate(ids[a:b].tolist(), a + 1):
                while state and w not in nxt[state]:
                    state = link[state]
                    n = length[state]
                state = nxt[state].get(w, 0)
                n = n + 1 if state else 0
                hit = 0
                if n >= window:
                    v = state
                    while length[link[v]] >= window:
                        v = link[v]
                    found |= self.items[v]
                    hit = window
                v = near[state]
                while v > 0:
                    for k, name in self.short[v]:
                        if k <= n:
                            found.add(name)
                            hit = max(hit, k)
                    v = near[link[v]]
                if hit:
                    start = i - hit
                    while spans and spans[-1][0] >= start:
                        spans.pop()
                    if spans and spans[-1][1] >= start:
                        spans[-1][1] = i
                    else:
                        spans.append([start, i])
        return [(a, b) for a, b in spans], found


def item_parts(items: DataFrame, id_col: str = "item_id", text_col: str = "text", max_words: int = MAX_WORDS) -> list[DataFrame]:
    """item, text: the items in parts of about max_words words. Items without words, and null texts, have no windows."""
    own = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null").distinct()
    total = own.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // (2 * max_words)))  # a word and its separator are two characters at least
    return [own if parts == 1 else own.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == k) for k in range(parts)]


def automaton_of(part: DataFrame, window: int = WINDOW) -> ItemAutomaton:
    """One part's automaton, so that what is broadcast has a fixed bound."""
    return ItemAutomaton([(r["item"], words_of(r["text"])) for r in part.collect()], window)


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The words of all spans as spans that ascend and do not touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def match_documents(docs: DataFrame, automaton: ItemAutomaton, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, spans (of word numbers, end exclusive), items: one row for each row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        get = machine.vocabulary.get
        for batch in in_slices(batches):
            _, texts = ids_and_texts(batch)
            n, spans, items = [], [], []
            for text in texts:
                words = words_of(text)
                n.append(len(words))
                at, found = machine.occurrences(np.fromiter((get(w, -1) for w in words), np.int64, len(words))) if len(words) >= machine.least else ([], set())
                spans.append([{"a": a, "b": b} for a, b in at])
                items.append([*sorted(found - {None}), *([None] if None in found else [])])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))), pa.array(items, pa.list_(pa.string()))],
                names=["id", "n_words", "spans", "items"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, n_words long, spans array<struct<a:long,b:long>>, items array<string>")


def match_parts(docs: DataFrame, parts: list[DataFrame], key_col: str, text_col: str, window: int) -> DataFrame:
    """id, n_words, spans, items over all parts: one row for each row of docs, whose key_col must not repeat.

    Each pass matches the texts as they came and is written, so one part's automaton is out at a time. The first pass
    keeps all rows, the others those with hits.
    """
    passes = []
    for k, part in enumerate(parts):
        found = match_documents(docs, automaton_of(part, window), key_col, text_col)
        passes.append(materialize(found if k == 0 else found.where("size(items) > 0"), f"items-{k}"))
    union = reduce(DataFrame.unionByName, passes)
    return union.groupBy("id").agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, max_words: int = MAX_WORDS) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated: one row for each row of docs.

    Null and empty texts have no words. Repeated rows each keep their row. Items of equal ids are one item; those of null
    ids are one without a name: it hits and counts, and adds nothing to items_sha256. With items past max_words, rows get a key
    that is written once, and the spans of all passes are united by it.
    """
    parts = item_parts(items, max_words=max_words)
    if len(parts) == 1:
        found = match_documents(docs, automaton_of(parts[0], window), id_col, text_col).withColumn("n_hit", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.b - s.a))
    else:
        keyed = materialize(docs.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id")).alias("key"), F.col(text_col).cast("string").alias("text")), "keyed")
        found = match_parts(keyed, parts, "key", "text", window).withColumn("id", F.col("id.id"))
        found = found.withColumn("n_hit", F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s.a, s.b - 1))))).cast("long"))
    return found.select("id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of spans and what stands between them."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in _WORD.finditer(raw)]
    out, end = [], 0
    for a, b in spans:
        out.append(raw[end : at[a][0]])
        end = at[b - 1][1]
    return b"".join([*out, raw[end:]]).decode("utf-8", "surrogatepass")


def remove_contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, text_col: str = "text", chars_col: str = "n_chars", window: int = WINDOW, max_coverage: float = 0.5, max_words: int = MAX_WORDS) -> DataFrame:
    """docs with hit spans cut out of their texts; rows whose hit words pass max_coverage of all words are dropped.

    All other rows and columns stay as they are, null and empty texts and repeated rows too; chars_col, if there, follows
    the new text. Columns may have any names.
    """
    names = docs.columns
    parts = item_parts(items, max_words=max_words)
    if len(parts) == 1:
        shared, out = spark.sparkContext.broadcast(automaton_of(parts[0], window)), docs
    else:
        row, spans = unused(docs, "__row"), unused(docs, "__spans")
        shared, keyed = None, materialize(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
        hits = match_parts(keyed, parts, row, text_col, window).where("size(spans) > 0").select(F.col("id").alias(row), F.col("spans").alias(spans))
        out = keyed.join(hits, row, "left").select(*[F.col(f"`{c}`") for c in names], spans)

    def spans_of(texts: list[str | None]) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        machine = shared.value
        get = machine.vocabulary.get
        for text in texts:
            words = words_of(text or "")
            yield len(words), machine.occurrences(np.fromiter((get(w, -1) for w in words), np.int64, len(words)))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.schema.get_field_index(text_col)
            texts, keep = batch.column(where).to_pylist(), []
            if shared is not None:
                found = spans_of(texts)
            else:
                given = batch.column(batch.num_columns - 1).to_pylist()
                found = ((len(words_of(t or "")) if s else 0, united([(x["a"], x["b"]) for x in s or ()])) for t, s in zip(list(texts), given, strict=True))
                batch = batch.select(list(range(batch.num_columns - 1)))
            changed = False
            for k, (n, spans) in enumerate(found):
                hit = sum(b - a for a, b in spans)
                keep.append(not hit or hit <= max_coverage * n)
                if hit:
                    texts[k] = without_spans(texts[k], spans)
                    changed = True
            columns = list(batch.columns)
            if changed:
                columns[where] = pa.array(texts, pa.string())
                if (c := batch.schema.get_field_index(chars_col)) >= 0:
                    new = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(c).type)
                    columns[c] = pa.compute.if_else(pa.compute.equal(columns[where], batch.column(where)).fill_null(True), batch.column(c), new)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([pa.field(f.name, c.type) for f, c in zip(batch.schema, columns, strict=True)])).filter(pa.array(keep, pa.bool_()))

    return out.select(*[F.col(f"`{c}`") for c in out.columns]).mapInArrow(run, docs.schema)
