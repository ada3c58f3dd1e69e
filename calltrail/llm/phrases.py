"""Phrase collocations: an FM-index over word ids for each shard, whose counts are summed across shards.

Texts become shards of word numbers by language, a few megabytes each. Words that occur often enough in their language get
ids, and each shard is rewritten in them: 0 between pieces, 1 for any rarer word. A shard's index holds two orders: of
what follows each place and of what precedes it, backwards, each with the symbol on the other side and where that symbol's
own place stands (the transform of the shard and of its reverse). A phrase is an interval in both; all phrases are grown by
a word at once, to the left or to the right, which gives the longer ones' intervals, counts, and how many occurrences have
a word to the left or right. Pairs go first; only phrases of pairs that are frequent over all shards are grown further, so
what is shuffled is a few rows for each word of the text, and no count is lost: a phrase is never more frequent than its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calltrail.llm import bloom
from calltrail.llm.common import discard, in_slices, materialize

#: Words of the longest phrase. Keys hold four ids of 32 bits.
DEPTH = 4
#: Occurrences of a candidate, and percents of them that drop it where a longer candidate has as many.
LEAST, WITHIN = 30, 80
#: Phrases of a language that are returned, and parts in which they are ranked before they meet.
TOP, PARTS = 2000, 64
#: Bytes of texts of one shard, a text at least.
SHARD = 5 << 20

#: A-Z are lower-cased, a tab is a blank, and what ends a piece is a line feed.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if c == 9 else c for c in range(256))

_SHARDS = "shard long, lang string, word string, local int, n long, seq binary"
_GRAMS = "k1 long, k2 long, a long, left long, right long"


# --- words and shards -----------------------------------------------------------------------------------------------


def numbered(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Different words of texts, and the texts as their numbers with -1 between pieces."""
    raw = b"\n".join(t.translate(_BYTES) for t in texts).replace(b"\n", b" \n ")
    found = pc.split_pattern(pa.array([raw], pa.large_binary()), b" ").flatten().dictionary_encode()
    words, seq = found.dictionary, found.indices.to_numpy()
    blank, end = (pc.index(words, pa.scalar(x, words.type)).as_py() for x in (b"", b"\n"))
    seq = seq[seq != blank]
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != end) | (seq[:-1] != end)
    number = np.arange(len(words), dtype=np.int32)
    own = (number != blank) & (number != end)
    number = np.where(own, np.cumsum(own) - 1, -1).astype(np.int32)
    return words.filter(pa.array(own)), number[seq[keep]]


def shards(docs: DataFrame) -> DataFrame:
    """Rows of words with their number and count in a shard, and a row with its sequence. docs: lang, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32  # a task that runs again names them again
        for batch in in_slices(batches, SHARD):
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for lang in dict.fromkeys(langs):
                words, seq = numbered([t for t, x in zip(texts, langs, strict=True) if x == lang])
                n = len(words)
                count = np.bincount(seq[seq >= 0], minlength=n)
                raw = zstandard.compress(seq.tobytes(), 1)
                columns = [pa.array([x] * (n + 1), t) for x, t in ((shard, pa.int64()), (lang, pa.string()))]
                columns += [pa.concat_arrays([words.cast(pa.large_string()).cast(pa.string()), pa.nulls(1, pa.string())]), pa.array([*range(n), None], pa.int32()), pa.array([*count.tolist(), None], pa.int64()), pa.array([None] * n + [raw], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "lang", "word", "local", "n", "seq"])
                shard += 1

    return docs.mapInArrow(run, _SHARDS)


def with_ids(totals: DataFrame) -> DataFrame:
    """totals with `id` from 2 on: places within the written partitions, after the counts of those before."""
    placed = materialize(totals.select("*", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("k")), "frequent-words")
    counts = placed.groupBy("p").agg(F.count("*").alias("c"))
    before = counts.select("p", (F.sum("c").over(Window.orderBy("p")) - F.col("c")).alias("before"))  # a row a partition
    out = materialize(placed.join(F.broadcast(before), "p").select("lang", "word", "n", (F.col("before") + F.col("k") + 2).alias("id")), "word-ids")
    discard(placed)
    if out.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0] >= 1 << 31:
        raise ValueError("more than 2^31 words are frequent: their ids have 31 bits")
    return out


def rewritten(table: DataFrame, ids: DataFrame) -> DataFrame:
    """shard, seq: sequences of ids, of shards with a frequent word."""
    own = table.where("word IS NOT NULL").select("shard", "lang", "word", "local").join(ids.select("lang", "word", "id"), ["lang", "word"])
    maps = own.groupBy("shard").agg(F.collect_list(F.struct("local", F.col("id").cast("int").alias("id"))).alias("ids"))  # as many as a shard has words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                seq = np.frombuffer(zstandard.decompress(batch.column(1)[k].as_py()), np.int32)
                found = batch.column(2)[k].values
                to = np.ones(int(seq.max(initial=0)) + 2, np.int32)
                to[-1] = 0  # -1, between pieces
                to[found.field("local").to_numpy()] = found.field("id").to_numpy()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), pa.array([zstandard.compress(to[seq].tobytes(), 1)], pa.binary())], names=["shard", "seq"])

    return table.where("seq IS NOT NULL").select("shard", "seq").join(maps, "shard").mapInArrow(run, "shard long, seq binary")


# --- the index ------------------------------------------------------------------------------------------------------


def _order(seq: np.ndarray) -> np.ndarray:
    """Places in the order of the DEPTH symbols from each one on."""
    rank = seq.astype(np.int64)
    width = 1
    while width < DEPTH:
        rest = np.zeros(len(rank), np.int64)
        rest[:-width] = rank[width:]
        key = rank << 32 | rest
        order = np.argsort(key, kind="stable")
        new = np.diff(key[order], prepend=-1) != 0
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(new)
        width *= 2
    return order


class Side:
    """One order of a shard: for each row the symbol on the other side, where the place that it stands at has its row, and
    how many rows before this one have a word there."""

    def __init__(self, seq: np.ndarray):
        order = _order(seq)
        row = np.empty(len(seq), np.int64)
        row[order] = np.arange(len(seq))
        self.symbol, self.back = seq[order - 1], row[order - 1]
        self.words = np.concatenate(([0], np.cumsum(self.symbol > 0)))


class Index:
    """Phrases are rows: ids (words of each), their first row ahead and behind, and their number of occurrences."""

    def __init__(self, seq: np.ndarray):
        ends = np.zeros(1, np.int32)
        seq = np.concatenate((ends, seq, ends))
        self.ahead, self.behind = Side(seq), Side(np.ascontiguousarray(seq[::-1]))
        count = np.bincount(seq)
        ids = np.flatnonzero(count)
        first = np.cumsum(count)[ids] - count[ids]
        word = ids > 1
        self.single = ids[word][:, None], first[word], first[word], count[ids[word]]

    @staticmethod
    def _grown(side: Side, at: np.ndarray, other: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(phrase, symbol, first row here, first row on the other side, occurrences) of all longer phrases of words.

        On the other side a phrase's rows stand in the order of the new symbol, so those of smaller symbols come before.
        """
        phrase = np.repeat(np.arange(len(at)), size)
        start = np.cumsum(size) - size
        row = np.arange(len(phrase)) - np.repeat(start - at, size)
        key = phrase << 32 | side.symbol[row]
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        key = key[order][first]
        phrase, symbol = key >> 32, key & 0xFFFFFFFF
        here = np.minimum.reduceat(side.back[row[order]], first) if len(first) else first
        there = other[phrase] + first - start[phrase]
        n = np.diff(np.append(first, len(order)))
        word = symbol > 1
        return phrase[word], symbol[word], here[word], there[word], n[word]

    def left(self, ids: np.ndarray, ahead: np.ndarray, behind: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        phrase, symbol, ahead, behind, n = self._grown(self.ahead, ahead, behind, n)
        return np.column_stack((symbol, ids[phrase])), ahead, behind, n

    def right(self, ids: np.ndarray, ahead: np.ndarray, behind: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        phrase, symbol, behind, ahead, n = self._grown(self.behind, behind, ahead, n)
        return np.column_stack((ids[phrase], symbol)), ahead, behind, n

    def extensions(self, ahead: np.ndarray, behind: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences with a word before them and after them in their piece."""
        return tuple(side.words[at + n] - side.words[at] for side, at in ((self.ahead, ahead), (self.behind, behind)))


def _where(keep: np.ndarray, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    return tuple(x[keep] for x in found)


def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) << 32 | b


def _rows(index: Index, found: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
    ids, ahead, behind, n = found
    zero = np.zeros(len(ids), np.int64)
    word = [ids[:, k] if k < ids.shape[1] else zero for k in range(DEPTH)]
    columns = [pair_key(word[0], word[1]), pair_key(word[2], word[3]), n, *index.extensions(ahead, behind, n)]
    whole = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k1", "k2", "a", "left", "right"])
    for at in range(0, whole.num_rows, 1 << 16):
        yield whole.slice(at, 1 << 16)


def pairs(index: Index) -> Iterator[pa.RecordBatch]:
    yield from _rows(index, index.left(*index.single))


def longer(index: Index, frequent: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Phrases of three and four words whose pairs are frequent: pairs grown to the left, then to the right."""
    found = index.left(*index.single)
    for grow, a, b in ((None, 0, 1), (index.left, 0, 1), (index.right, 2, 3)):
        if grow is not None:
            found = grow(*found)
        found = _where(frequent(pair_key(found[0][:, a], found[0][:, b])), found)
        if grow is not None:
            yield from _rows(index, found)


def _index_of(raw: bytes) -> Index:
    return Index(np.frombuffer(zstandard.decompress(raw), np.int32))


def pair_counts(own: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from pairs(_index_of(batch.column(0)[k].as_py()))

    return own.select("seq").mapInArrow(run, _GRAMS)


def longer_counts(own: DataFrame, frequent: DataFrame) -> DataFrame:
    """Frequent pairs (k1) go to the shards as a Bloom filter while it has its bound, else each shard is joined with its
    own. What the filter lets through falls to the sums."""
    filter_ = bloom.build(frequent, "k1", frequent.count())
    shared = own.sparkSession.sparkContext.broadcast(filter_) if filter_ is not None else None
    rows = own.select("seq")
    if shared is None:

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    for part in pairs(_index_of(batch.column(1)[k].as_py())):
                        yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[k].as_py()] * part.num_rows, pa.int64()), part.column(0)], names=["shard", "k1"])

        found = own.select("shard", "seq").mapInArrow(each, "shard long, k1 long").join(frequent.select("k1"), "k1", "left_semi")
        rows = own.join(found.groupBy("shard").agg(F.array_sort(F.collect_list("k1")).alias("keys")), "shard").select("seq", "keys")  # as many as a shard has pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                known = shared.value if shared is not None else _within(batch.column(1)[k].values.to_numpy())
                yield from longer(_index_of(batch.column(0)[k].as_py()), known)

    return rows.mapInArrow(run, _GRAMS)


def _within(keys: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    return lambda found: np.isin(found, keys)


# --- candidates -----------------------------------------------------------------------------------------------------


def words_of(k1: str = "k1", k2: str = "k2") -> Column:
    """Ids of a phrase's words."""
    low = F.lit(0xFFFFFFFF)
    four = F.array(F.shiftright(k1, 32), F.col(k1).bitwiseAND(low), F.shiftright(k2, 32), F.col(k2).bitwiseAND(low))
    return F.filter(four, lambda x: x > 0)


def keys_of(words: Column) -> list[Column]:
    at = [F.coalesce(F.get(words, k), F.lit(0).cast("long")) for k in range(DEPTH)]
    return [F.shiftleft(at[k], 32).bitwiseOR(at[k + 1]) for k in (0, 2)]


def _keyed(df: DataFrame, words: Column, name: str) -> DataFrame:
    k1, k2 = keys_of(words)
    return df.withColumn(f"{name}1", k1).withColumn(f"{name}2", k2)


def scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """k1, k2, a, left, right, l, r, score: of the lowest-scoring cut. counts: k1, k2, f of words and candidates.

    2000000 a / (l + r) is taken in two steps, so that no product passes 64 bits below 4e15 occurrences.
    """
    cut = candidates.withColumn("w", words_of()).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cut = _keyed(_keyed(cut, F.slice("w", F.lit(1), F.col("k")), "p"), F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), "q").drop("w")
    for part, f in (("p", "l"), ("q", "r")):
        cut = cut.join(counts.select(F.col("k1").alias(f"{part}1"), F.col("k2").alias(f"{part}2"), F.col("f").alias(f)), [f"{part}1", f"{part}2"])
    score = F.expr("(a * 1000 div (l + r)) * 2000 + (a * 1000 % (l + r)) * 2000 div (l + r)")
    return cut.groupBy("k1", "k2", "a", "left", "right").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m")).select("k1", "k2", "a", "left", "right", "m.l", "m.r", "m.score")


def undropped(candidates: DataFrame) -> DataFrame:
    """Candidates that no longer candidate stands for. One longer by a word tells: between a phrase and one longer by two
    stands one that is as frequent as the latter at least."""
    inner = candidates.where("k2 <> 0").withColumn("w", words_of()).withColumn("at", F.explode(F.array(F.lit(1), F.lit(2))))
    k1, k2 = keys_of(F.slice("w", F.col("at"), F.size("w") - 1))
    most = inner.select(k1.alias("k1"), k2.alias("k2"), "a").groupBy("k1", "k2").agg(F.max("a").alias("most"))
    return candidates.join(most, ["k1", "k2"], "left").where(f"most IS NULL OR 100 * most < {WITHIN} * a").drop("most")


def collocations(spark: SparkSession, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, left, right: each language's first `top` phrases of two to four words.

    left, right: occurrences that have a word before, after them in their piece. Null langs are `und`, null texts empty;
    repeated rows count each time; a language without candidates has no row, nor has an empty table. Ties go by a, then phrase.
    """
    own = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    table = materialize(shards(own), "shards")
    totals = materialize(table.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    n = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    ids = with_ids(totals.where(F.col("n") >= least))
    coded = materialize(rewritten(table, ids), "coded-shards")
    discard(table)
    sums = [F.sum(c).alias(c) for c in ("a", "left", "right")]
    two = materialize(pair_counts(coded).groupBy("k1", "k2").agg(*sums).where(F.col("a") >= least), "pairs")
    more = longer_counts(coded, two).groupBy("k1", "k2").agg(*sums).where(F.col("a") >= least)
    candidates = materialize(two.unionByName(more), "candidates")
    discard(two, coded)
    counts = candidates.select("k1", "k2", F.col("a").alias("f")).unionByName(ids.select(F.shiftleft("id", 32).alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("n").alias("f")))
    found = scored(undropped(candidates), counts).select("*", F.posexplode(words_of()).alias("at", "id")).join(ids.select("id", "lang", "word"), "id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ")
    named = found.groupBy("lang", "k1", "k2", "a", "left", "right", "l", "r", "score").agg(text.alias("phrase"))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = named.withColumn("part", F.pmod(F.xxhash64("k1", "k2"), F.lit(PARTS)))
    first = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    out = materialize(ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "left", "right"), "phrases")
    discard(totals, ids, candidates)
    return out
