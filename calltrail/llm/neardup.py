"""Near duplicates: BagMinHash signatures of word-shingle multisets, bands, and verified multiset overlap.

A shingle's weight is its count in the text. The weight axis is cut at powers of two; on each piece a Poisson process
of that shingle throws points of (time, register, weight), and those up to the shingle's weight count. A register's value
is its first time, so two texts agree in a register with the chance of their weighted Jaccard similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calltrail.llm.common import discard, ids_and_texts, in_slices, materialize, text_digest, unused, worker_state

WORDS, SIMILARITY = 5, 0.8
#: 32 bands of 6 registers: at a similarity of 0.8 all bands miss with a chance of 6e-5.
BANDS, ROWS = 32, 6
#: Pivot rounds in a bucket before its remaining pairs are compared.
PIVOT_ROUNDS = 1
#: Shingles in one vectorised step.
STEP_SHINGLES = 200_000

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * _A
    x ^= x >> np.uint64(27)
    x *= _B
    x ^= x >> np.uint64(31)
    return x


def _step(k: int) -> np.uint64:
    return np.uint64(k * int(_GOLD) & 0xFFFFFFFFFFFFFFFF)


def shingles(texts: list[str], words: int = WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text, hashes of its runs of five lower-cased words, and their counts. A shorter text is one shingle, or none.

    All texts' words are numbered first, so that each is hashed once.
    """
    split = [t.lower().split() for t in texts]
    coded = pa.array(list(chain.from_iterable(split)), pa.large_string()).dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w.encode()) for w in coded.dictionary.to_pylist()], np.uint64)
    whole = hashes[coded.indices.to_numpy()] if len(hashes) else hashes
    out, at = [], 0
    for found in split:
        h = whole[at : at + len(found)]
        at += len(found)
        if not len(h):
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
            continue
        n = max(1, len(h) - words + 1)
        run = np.full(n, len(h) if len(h) < words else words, np.uint64)
        for k in range(min(words, len(h))):
            run = run * _GOLD + h[k : k + n]
        out.append(np.unique(_mix(run), return_counts=True))
    return out


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: sum of smaller counts by sum of larger ones."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both) if both else 0.0


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = BANDS * ROWS) -> np.ndarray:
    """First times by set and register; sets without shingles have none (infinity).

    Points come in the order of time for each process, up to a time by which all registers most likely have one. A set
    with an empty register is done again up to twice that time; what is found does not depend on the limit.
    """
    sig = np.full((len(sets), registers), np.inf)
    total = np.array([c.sum() for _, c in sets], float)
    todo = np.flatnonzero(total > 0)
    reach = registers * (np.log(registers) + 4)
    while len(todo):
        _throw(sets, todo, sig, reach / np.maximum(total, 1), registers)
        todo = todo[np.isinf(sig[todo]).any(axis=1)]
        reach *= 2
    return sig


def _throw(sets: list[tuple[np.ndarray, np.ndarray]], todo: np.ndarray, sig: np.ndarray, until: np.ndarray, registers: int) -> None:
    sizes = [len(sets[i][0]) for i in todo]
    key = np.concatenate([sets[i][0] for i in todo])
    count = np.concatenate([sets[i][1] for i in todo]).astype(float)
    owner = np.repeat(todo, sizes)
    flat = sig.reshape(-1)
    level, low, high = 0, 0.0, 1.0
    while len(key):
        _process(_mix(key + _step(level + 1)), owner, count, low, high, until, flat, registers)
        live = count > high
        key, owner, count = key[live], owner[live], count[live]
        level, low, high = level + 1, high, high * 2


def _process(seed: np.ndarray, owner: np.ndarray, count: np.ndarray, low: float, high: float, until: np.ndarray, flat: np.ndarray, registers: int) -> None:
    """Points on the weights (low, high] of all shingles at once, the first of each, then the second, and so on."""
    time, limit, rate = np.zeros(len(seed)), until[owner], high - low
    partial = count < high
    whole = not partial.any()
    k = 0
    while len(seed):
        k += 1
        r = _mix(seed + _step(k))
        time = time - np.log(((r >> np.uint64(11)).astype(float) + 1.0) * 2.0**-53) / rate
        live = time <= limit
        if not live.all():
            seed, owner, count, time, limit, r = seed[live], owner[live], count[live], time[live], limit[live], r[live]
            if not len(seed):
                return
        spot = _mix(r ^ _B)
        where = owner * registers + (spot % np.uint64(registers)).astype(np.int64)
        if whole:
            np.minimum.at(flat, where, time)
        else:
            mark = low + rate * ((_mix(spot) >> np.uint64(11)).astype(float) * 2.0**-53)
            inside = mark < count
            np.minimum.at(flat, where[inside], time[inside])


def bands_of(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    bits = sig.view(np.uint64).reshape(len(sig), bands, rows)
    h = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)) * _GOLD
    for k in range(rows):
        h = _mix(h ^ bits[:, :, k])
    return h.view(np.int64)


def band_rows(docs: DataFrame, digest_col: str, text_col: str) -> DataFrame:
    """digest, total (sum of counts) and band: a row for each distinct text and band. Texts without words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(("shingles",), dict)  # lets go of what another kind of task has kept
        keep, held, size = [], [], 0
        for batch in in_slices(batches):
            digests, texts = ids_and_texts(batch)
            once = dict(zip(digests, texts, strict=True))
            for digest, s in zip(once, shingles(list(once.values())), strict=True):
                if len(s[0]):
                    keep.append(digest)
                    held.append(s)
                    size += len(s[0])
                if size >= STEP_SHINGLES:
                    yield out(keep, held)
                    keep, held, size = [], [], 0
        yield out(keep, held)

    def out(keep: list, held: list) -> pa.RecordBatch:
        bands = bands_of(signatures(held)) if held else np.zeros((0, BANDS), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(keep, pa.binary()), pa.array([int(c.sum()) for _, c in held], pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1) * BANDS, pa.int32()), pa.array(bands.ravel(), pa.int64()))],
            names=["digest", "total", "bands"],
        )

    found = docs.select(digest_col, F.col(text_col).cast("string")).mapInArrow(run, "digest binary, total long, bands array<long>")
    once = found.dropDuplicates(["digest"])  # equal texts have equal bands: one row each meets the others
    return once.select("digest", "total", F.explode(F.array_distinct("bands")).alias("band"))


def verified(docs: DataFrame, pairs: DataFrame, digest_col: str, text_col: str, chosen: DataFrame, id_col: str) -> DataFrame:
    """a, b, similarity of pairs (a, b) of digests. A text comes from the row with its digest's smallest id.

    Texts move by digest: to b, where they spread evenly, then to a, where a hot pivot's pairs are a skewed join that
    Spark splits.
    """
    needed = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct().join(chosen, "digest")
    texts = docs.select(F.col(digest_col).alias("digest"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(needed, "digest").where(F.col("id").eqNullSafe(F.col("first_id"))).select("digest", "text")
    texts = materialize(texts, "pair-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, column=3):
            left, right = ([t or "" for t in batch.column(k).to_pylist()] for k in (2, 3))
            once = list(dict.fromkeys([*left, *right]))
            sets = dict(zip(once, shingles(once), strict=True))
            sims = [overlap(sets[a], sets[b]) for a, b in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sims, pa.float64())], names=["a", "b", "similarity"])

    with_b = pairs.join(texts.select(F.col("digest").alias("b"), F.col("text").alias("right")), "b")
    both = with_b.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("left")), "a").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a binary, b binary, similarity double").dropDuplicates(["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """node, root: connected components of edges (u, v) by large and small stars; root is the smallest node.

    Each round is two joins and a written table; a node's neighbours never meet in one row.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        last, now = now, materialize(small, "edges")
        discard(last)
        found = state(now)
        if found == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = found


def _pivot(k: int) -> Column:
    """First the text with the most company over all its buckets, which is the original sooner than a copy; then others."""
    if k == 0:
        return F.struct("degree", "digest")
    return F.unhex(F.substring(F.sha2(F.concat("digest", F.lit(str(k)).cast("binary")), 256), 1, 16))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(rows, links): id and digest of each row; verified pairs (u, v) of digests that join all near duplicates.

    In a bucket (texts that agree in a band) all texts are compared with one pivot, in further rounds with others.
    After that, texts of mixed buckets (of several components) are joined on rare shingles: a pair of that similarity
    must share one among the rarest of each, at places that leave room for the overlap it needs. This rules out no link,
    and it does not pair the members of a component. So no components stay apart that a bucket's pair would join.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("__digest", text_digest("text"))
    id_col, text_col = "id", "text"
    rows = own.select(F.col(id_col).alias("id"), F.col("__digest").alias("digest"))
    chosen = rows.groupBy("digest").agg(F.min("id").alias("first_id"))
    whole = materialize(band_rows(own, "__digest", text_col), "bands")
    members = whole.join(whole.groupBy("band").agg(F.count("*").alias("__n")).where("__n > 1"), "band")
    degree = members.groupBy("digest").agg(F.sum("__n").alias("degree"))
    members = materialize(members.drop("__n").join(degree, "digest"), "buckets")
    discard(whole)
    edges, tested, root = None, None, None
    for k in range(PIVOT_ROUNDS):
        now = members if root is None else _with_roots(members, root)
        if root is not None:
            mixed = now.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("band")
            now = materialize(now.join(mixed, "band"), "mixed")
        pivots = now.groupBy("band").agg(F.max_by(F.struct("digest", "total", *(["root"] if root is not None else [])), _pivot(k)).alias("p"))
        pairs = now.join(pivots, "band").where("digest <> p.digest").where(F.least("total", "p.total") >= similarity * F.greatest("total", "p.total"))
        if root is not None:
            pairs = pairs.where("root <> p.root")
        pairs = pairs.select(F.least("digest", "p.digest").alias("a"), F.greatest("digest", "p.digest").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        sims = materialize(verified(own, pairs, "__digest", text_col, chosen, id_col), "similarities")
        tested = sims if tested is None else tested.unionByName(sims)
        edges = tested.where(F.col("similarity") >= similarity).select(F.col("a").alias("u"), F.col("b").alias("v"))
        root = components(edges)
    rest = materialize(_rest(own, chosen, id_col, text_col, members, root, tested, similarity), "rest-pairs")
    if not rest.isEmpty():
        more = materialize(verified(own, rest, "__digest", text_col, chosen, id_col), "similarities")
        edges = edges.union(more.where(F.col("similarity") >= similarity).select("a", "b"))
    return rows, edges


def _with_roots(members: DataFrame, root: DataFrame) -> DataFrame:
    return members.join(root.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))


def token_rows(texts: DataFrame) -> DataFrame:
    """digest, root, total, token of texts (digest, root, text): the k-th occurrence of a shingle is a token of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, column=2):
            digests, roots, found = (c.to_pylist() for c in batch.columns)
            for digest, root, (keys, counts) in zip(digests, roots, shingles([t or "" for t in found]), strict=True):
                n = int(counts.sum())
                first = np.concatenate(([0], np.cumsum(counts)))[:-1]
                nth = np.arange(n) - np.repeat(first, counts)
                tokens = _mix(np.repeat(keys, counts) + nth.astype(np.uint64) * _GOLD).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([digest] * n, pa.binary()), pa.array([root] * n, pa.binary()), pa.array([n] * n, pa.int64()), pa.array(tokens)], names=["digest", "root", "total", "token"])

    return texts.select("digest", "root", "text").mapInArrow(run, "digest binary, root binary, total long, token long")


def _rest(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, members: DataFrame, root: DataFrame, tested: DataFrame, similarity: float) -> DataFrame:
    """Pairs of texts of mixed buckets, in different components, that may reach the similarity and are not tested yet."""
    now = _with_roots(members, root)
    mixed = now.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("band")
    open_ = now.join(mixed, "band").select("digest", "root").distinct().join(chosen, "digest")
    texts = docs.select(F.col("__digest").alias("digest"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(open_, "digest").where(F.col("id").eqNullSafe(F.col("first_id"))).dropDuplicates(["digest"])
    tokens = materialize(token_rows(texts), "tokens")
    counted = tokens.join(tokens.groupBy("token").agg(F.count("*").alias("n")), "token")
    place = F.row_number().over(Window.partitionBy("digest").orderBy("n", "token"))
    prefix = counted.withColumn("at", place).where(F.col("at") <= F.col("total") - F.ceil(F.col("total") * similarity) + 1).where("n > 1").drop("n")
    prefix = materialize(prefix, "prefixes")
    shared = prefix.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("token")
    prefix = prefix.join(shared, "token")
    left = prefix.select("token", *[F.col(c).alias(f"{c}_l") for c in ("digest", "root", "total", "at")])
    needed = F.ceil((F.col("total") + F.col("total_l")) * similarity / (1 + similarity) - 1e-9)
    room = 1 + F.least(F.col("total") - F.col("at"), F.col("total_l") - F.col("at_l"))
    where = (F.col("digest_l") < F.col("digest")) & (F.col("root_l") != F.col("root")) & (F.least("total", "total_l") >= similarity * F.greatest("total", "total_l")) & (room >= needed)
    pairs = left.join(prefix, "token").where(where).select(F.col("digest_l").alias("a"), F.col("digest").alias("b")).distinct()
    return pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")


def groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """id, text_id (smallest id of the same text), group_id (smallest id of the near-duplicate group), n_links (other texts
    that were found to be near this one), digest: a row for each row of docs.

    Null and empty texts are one text and join no other. Null ids come after all others.
    """
    rows, edges = links(docs, id_col, text_col, similarity)
    root = components(edges)
    degree = edges.union(edges.select("v", "u")).groupBy(F.col("u").alias("digest")).agg(F.count("*").alias("n_links"))
    texts = rows.groupBy("digest").agg(F.min("id").alias("text_id"))
    named = texts.join(root.withColumnRenamed("node", "digest"), "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    firsts = named.groupBy("root").agg(F.min("text_id").alias("group_id"), F.min(F.struct(F.col("text_id").isNull().alias("none"), "text_id", "digest")).alias("kept"))
    named = named.join(firsts, "root").join(degree, "digest", "left").select("digest", "text_id", "group_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.col("kept.digest").alias("kept_digest"))
    return rows.join(named, "digest").select("id", "text_id", "group_id", "n_links", "digest", "kept_digest")


def keep_one(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """docs with one row of each near-duplicate group: the one of the smallest id, whole rows that repeat counting once.

    Null and empty texts are one group. Of rows with that id and text but other columns, one stays. A null id stays only
    where its group has no other. Columns may have any names.
    """
    found = groups(spark, docs, id_col, text_col, similarity)
    d, i, n = (unused(docs, c) for c in ("__digest", "__id", "__n"))
    kept = found.where(F.col("digest") == F.col("kept_digest")).where(F.col("id").eqNullSafe(F.col("text_id")))
    kept = kept.groupBy(F.col("digest").alias(d)).agg(F.min("id").alias(i), F.count("*").alias(n))
    own = docs.withColumn(d, text_digest(text_col)).join(kept, d).where(F.col(id_col).eqNullSafe(F.col(i)))
    once = own.where(F.col(n) == 1).drop(i, n, d)
    more = own.where(F.col(n) > 1).dropDuplicates([d]).drop(i, n, d)
    return once.unionByName(more).select(*[F.col(f"`{c}`") for c in docs.columns])
