"""Source divergence audit by in-mapper stripes: how far the words of each source of a language lie from other sources' and the language's.

Each task folds whole documents into stripes, term -> (documents, occurrences in each source), and spills them as rows
after a number of bytes of texts, so its memory does not grow with the input. Spilled stripes meet
by (language, term) and are added up; a term's merged stripe is at most as long as its language has sources. Totals of the
groups come from the merged stripes, and a second pass over these emits divergences: sums of pairs of sources, and the
terms that stand out in a source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calltrail.llm.common import discard, in_slices, materialize

#: A term stays where this many documents of its language have it.
MIN_DOCUMENTS = 10
#: Shares are whole parts of this number.
SCALE = 1_000_000_000
#: Ranks of a group's terms that are returned.
TOP = 10
#: Bytes of documents that a task folds, a document at least, before it spills the stripes.
FOLD = 12 << 20
#: Counts that a worker lays out side by side, terms times sources.
TABLE = 1 << 20
#: Groups whose totals are broadcast; where there are more they are joined.
MOST_GROUPS = 50_000

#: ASCII letters are lower-cased, other ASCII characters part terms, all further bytes are of terms.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

_STRIPES = "lang string, term string, documents long, cells array<struct<source:string,n:long>>"


def _sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, ascending, and the sums of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v for v in values)


def _stripes(lang: pa.Array, term: pa.Array, documents: np.ndarray, owner: np.ndarray, source: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    """Rows of stripes. owner: the row of each cell, ascending."""
    cells = pa.StructArray.from_arrays([source, pa.array(n, pa.int64())], ["source", "n"])
    edges = pa.array(np.searchsorted(owner, np.arange(len(term) + 1)), pa.int32())
    return pa.RecordBatch.from_arrays([lang, term, pa.array(documents, pa.int64()), pa.ListArray.from_arrays(edges, cells)], names=["lang", "term", "documents", "cells"])


def fold(texts: list[bytes], langs: pa.Array, sources: pa.Array) -> pa.RecordBatch:
    """The stripes of whole documents. Words become numbers by one hash table; each document's words are counted, and its
    counts are added to the cells of its language and source."""
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    of_lang, of_source = lang.indices.to_numpy(), source.indices.to_numpy()
    split = pc.split_pattern(pa.array([t.translate(_LETTERS) for t in texts], pa.binary()), b" ")
    words = split.flatten().dictionary_encode()
    code = words.indices.to_numpy()
    document = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    blank = pc.index(words.dictionary, pa.scalar(b"", pa.binary())).as_py()
    document, code = document[code != blank], code[code != blank]
    k, g = len(words.dictionary), len(source.dictionary)
    own, n = _sums(document * k + code, np.ones(len(code), np.int64))
    document, code = own // k, own % k
    cell, documents, n = _sums((of_lang[document] * k + code) * g + of_source[document], np.ones(len(own), np.int64), n)
    row, documents = _sums(cell // g, documents)
    names = lang.dictionary.take(pa.array(row // k)), words.dictionary.cast(pa.string()).take(pa.array(row % k))
    return _stripes(*names, documents, np.searchsorted(row, cell // g), source.dictionary.take(pa.array(cell % g)), n)


def folded(docs: DataFrame) -> DataFrame:
    """Spilled stripes of docs (text, lang, source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, FOLD, column=0):
            yield fold(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1), batch.column(2))

    return docs.mapInArrow(run, _STRIPES)


def add_up(sorted_: pa.RecordBatch) -> pa.RecordBatch:
    """One stripe for each run of stripes of one language and term."""
    lang, term, cells = sorted_.column("lang"), sorted_.column("term"), sorted_.column("cells")
    new = np.ones(sorted_.num_rows, bool)
    new[1:] = pc.or_(pc.not_equal(term[1:], term[:-1]), pc.not_equal(lang[1:], lang[:-1])).to_numpy(zero_copy_only=False)
    row, first = np.cumsum(new) - 1, pa.array(np.flatnonzero(new))
    flat = cells.flatten()
    source = flat.field("source").dictionary_encode()
    g = len(source.dictionary)
    cell, n = _sums(np.repeat(row, np.diff(cells.offsets.to_numpy())) * g + source.indices.to_numpy(), flat.field("n").to_numpy())
    documents = _sums(row, sorted_.column("documents").to_numpy())[1]
    return _stripes(lang.take(first), term.take(first), documents, cell // g, source.dictionary.take(pa.array(cell % g)), n)


def merged(spilled: DataFrame, least: int) -> DataFrame:
    """The whole stripes of terms that `least` documents have: one shuffle by language and term, then runs of a sorted
    stream are added up, so a worker holds one batch and one stripe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch.cast(held.schema)]).combine_chunks()
            found = add_up(table.to_batches()[0])
            whole, held = found.slice(0, found.num_rows - 1), pa.Table.from_batches([found.slice(found.num_rows - 1)]).combine_chunks().to_batches()[0]
            yield whole.filter(pc.greater_equal(whole.column("documents"), least))
        if held is not None:
            yield held.filter(pc.greater_equal(held.column("documents"), least))

    return spilled.repartition("lang", "term").sortWithinPartitions("term", "lang").mapInArrow(run, _STRIPES)


def shares(counts: np.ndarray, totals: np.ndarray, v: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 v)), exact: the quotient is drawn three decimal digits at a time."""
    whole = totals + 2 * v
    q, rest = np.divmod(counts + 2, whole)
    for _ in range(3):
        rest *= 1000
        q *= 1000
        q += rest // whole
        rest %= whole
    return q + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of shares; the square stays below 2^63."""
    d = p - q
    return d * d // (p + q)


class Language:
    """What a worker needs of a language: its sources, their totals, its number of terms; and the sums of pairs so far."""

    def __init__(self, sources: list[str], totals: list[int], v: int):
        self.sources, self.v = sources, v
        self.totals = np.array(totals, np.int64)
        self.names = pa.array(sources, pa.string())
        self.pairs = np.zeros((len(sources), len(sources)), np.int64)

    def see(self, term: pa.Array, cells: pa.ListArray) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
        """Adds terms' stripes to the sums of pairs; (source, terms, values) of those that may be its first TOP. term: ascending."""
        edges = cells.offsets.to_numpy()
        flat = cells.flatten()
        column, n = pc.index_in(flat.field("source"), self.names).to_numpy(), flat.field("n").to_numpy()
        row = np.repeat(np.arange(len(term)), np.diff(edges))
        step = max(1, TABLE // len(self.sources))
        for a in range(0, len(term), step):
            b = min(len(term), a + step)
            own = slice(*(edges[[a, b]] - edges[0]))
            counts = np.zeros((b - a, len(self.sources)), np.int64)
            counts[row[own] - a, column[own]] = n[own]
            p = shares(counts, self.totals, self.v)
            q = shares(counts.sum(axis=1), self.totals.sum(), self.v)
            for s in range(len(self.sources)):
                self.pairs[s, s + 1 :] += divergence(p[:, s : s + 1], p[:, s + 1 :]).sum(axis=0)
                at = np.flatnonzero((counts[:, s] > 0) & (p[:, s] > q))
                value = divergence(p[at, s], q[at])
                best = np.argsort(-value, kind="stable")[:TOP]  # ties stay in the order of terms
                if len(best):
                    yield self.sources[s], term.take(pa.array(a + at[best])), value[best]


def emitted(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, part, item, value: sums of pairs and candidates of terms, task by task. groups: lang, sources, totals, v."""
    n = groups.agg(F.coalesce(F.sum(F.size("sources")), F.lit(0))).first()[0]
    known = {r["lang"]: (r["sources"], r["totals"], r["v"]) for r in groups.collect()} if n <= MOST_GROUPS else None
    shared = kept.sparkSession.sparkContext.broadcast(known) if known is not None else None
    rows = kept if shared is not None else kept.join(groups, "lang")

    def batch_of(lang: str, source: list[str] | str, part: str, item: pa.Array, value: np.ndarray) -> pa.RecordBatch:
        n = len(item)
        columns = [pa.array([lang] * n, pa.string()), pa.array([source] * n if isinstance(source, str) else source, pa.string()), pa.array([part] * n, pa.string()), item, pa.array(value, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "part", "item", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, Language] = {}
        for batch in batches:
            order = pc.sort_indices(pa.table({"lang": batch.column("lang"), "term": batch.column("term").cast(pa.binary())}), sort_keys=[("lang", "ascending"), ("term", "ascending")])
            batch = batch.take(order)
            for lang in pc.unique(batch.column("lang")).to_pylist():
                own = batch.filter(pc.equal(batch.column("lang"), lang))
                if lang not in langs:
                    langs[lang] = Language(*(shared.value[lang] if shared is not None else (own.column(c)[0].as_py() for c in ("sources", "totals", "v"))))
                for source, item, value in langs[lang].see(own.column("term"), own.column("cells")):
                    yield batch_of(lang, source, "term", item, value)
        for lang, own in langs.items():
            for s, source in enumerate(own.sources[:-1]):
                yield batch_of(lang, source, "pair", own.names[s + 1 :], own.pairs[s, s + 1 :])

    return rows.mapInArrow(run, "lang string, source string, part string, item string, value long")


def audit(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = MIN_DOCUMENTS) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair`: a row for each other source of the language, the sum over its terms; part `term`: the first TOP terms of
    the group that lie above their language's share. Null texts, langs and sources are ''; a group without terms has its
    pairs; a repeated row counts as a document of its own; an empty table gives none. Ties go by item.
    """
    own = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    kept = materialize(merged(folded(own), least), "stripes")
    totals = kept.select("lang", F.explode("cells").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("total"))
    group = own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    sources = F.array_sort(F.collect_list(F.struct("source", "total")))
    by_lang = group.groupBy("lang").agg(sources.alias("s")).join(kept.groupBy("lang").agg(F.count("*").alias("v")), "lang", "left")
    groups = materialize(by_lang.select("lang", F.col("s.source").alias("sources"), F.col("s.total").alias("totals"), F.coalesce("v", F.lit(0)).alias("v")), "groups")
    found = materialize(emitted(kept, groups), "divergences")
    discard(kept)
    one = groups.select("lang", F.explode("sources").alias("source"))
    sums = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    all_pairs = one.join(one.withColumnRenamed("source", "item"), "lang").where("source <> item")
    pairs = all_pairs.join(both, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    w = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(found.where("part = 'term'").select("lang", "source", "part", "item", "value")).withColumn("rank", F.row_number().over(w))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= TOP))
