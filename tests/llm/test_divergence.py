"""The source divergence audit against a plain version with whole numbers of any size."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from calltrail.llm import divergence

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, term STRING, cells STRING, n STRING"


def plain(rows, least):
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), lang or "", s or "") for t, lang, s in rows]
    out = set()
    for lang in {d[1] for d in docs}:
        own = [d for d in docs if d[1] == lang]
        df = Counter(w for ws, _, _ in own for w in set(ws))
        kept = [w for w in df if df[w] >= least]
        counts = {s: Counter(w for ws, _, x in own if x == s for w in ws if w in kept) for s in {d[2] for d in own}}
        whole = sum(counts.values(), Counter())

        def share(c, w, kept=kept):
            return 1 + 10**9 * (c[w] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        for s in counts:
            pairs = [(x, sum(f(share(counts[s], w), share(counts[x], w)) for w in kept)) for x in counts if x != s]
            terms = [(w, f(share(counts[s], w), share(whole, w))) for w in kept if counts[s][w] and share(counts[s], w) > share(whole, w)]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[1], x[0].encode()))[:10])):
                out |= {(lang, s, part, item, v, k) for k, (item, v) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode())), 1)}
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    words = ["the", "The", "of", "water", "été", "日本", "x9y", "stone-house", "É", "z\tq", "😀"]
    out = [(" ".join(r.choice(words[: r.randint(2, 11)]) for _ in range(r.randint(0, 30))), r.choice(["en", "fr", None, ""]), r.choice(["a", "a", "a", "b", "c", None])) for _ in range(300)]
    return [*out, (None, "en", "only nulls"), ("", "de", "x"), (None, "de", "y"), ("one two", "it", "z"), (None, None, None), ("the " * 50_000, "en", "b"), out[0], out[0]]


def table(spark, rows):
    return spark.createDataFrame([(k, *r, "clash", "clash", "clash") for k, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("least", [1, 3, 10])
def test_same_as_plain(spark, rows, least):
    docs = table(spark, rows).repartition(7)
    got = divergence.audit(spark, docs, least=least).collect()
    assert {tuple(r) for r in got} == plain(rows, least) and len(got) == len(plain(rows, least))


def test_joined_totals_give_the_same(spark, rows, monkeypatch):
    docs = table(spark, rows)
    monkeypatch.setattr(divergence, "MOST_GROUPS", 0)
    assert {tuple(r) for r in divergence.audit(spark, docs, least=2).collect()} == plain(rows, 2)


def test_empty_table(spark):
    assert divergence.audit(spark, spark.createDataFrame([], SCHEMA)).collect() == []


def test_shares_of_large_counts_are_exact():
    counts, total, v = np.array([0, 1, 10**13, 3 * 10**14 + 7]), np.array([5 * 10**14 + 3]), 10**6
    assert divergence.shares(counts, total, v).tolist() == [1 + 10**9 * (c + 2) // (5 * 10**14 + 3 + 2 * v) for c in counts.tolist()]


def test_stripes_add_up_over_batches():
    texts = [b"a b a", b"b c", b"a", b""]
    parts = [divergence.fold([t], pa.array(["en"]), pa.array([s])) for t, s in zip(texts, "xyxz", strict=True)]
    whole = pa.Table.from_batches(parts).sort_by([("term", "ascending")]).combine_chunks().to_batches()[0]
    rows = defaultdict(dict)
    for r in divergence.add_up(whole).to_pylist():
        rows[r["term"]] = (r["documents"], {c["source"]: c["n"] for c in r["cells"]})
    assert rows == {"a": (2, {"x": 3}), "b": (2, {"x": 1, "y": 1}), "c": (1, {"y": 1})}
