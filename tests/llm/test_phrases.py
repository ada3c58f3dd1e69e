"""Phrase collocations against a plain version, and the index against plain counts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from calltrail.llm import bloom, phrases

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, n STRING, word STRING, id STRING, `left` STRING"


def grams(rows):
    """Counts of all phrases of one to four words by language, with occurrences that have a word to the left and right."""
    out, n = {}, Counter()
    for text, lang in rows:
        own = out.setdefault("und" if lang is None else lang, {})
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n["und" if lang is None else lang] += len(w)
            for m in range(1, 5):
                for k in range(len(w) - m + 1):
                    x = own.setdefault(tuple(w[k : k + m]), [0, 0, 0])
                    x[0] += 1
                    x[1] += k > 0
                    x[2] += k + m < len(w)
    return out, n


def plain(rows, least, top):
    found, n = grams(rows)
    out = []
    for lang, own in found.items():
        f = {g: x[0] for g, x in own.items()}
        candidates = [g for g in f if len(g) > 1 and f[g] >= least]
        most = Counter()
        for g in candidates:
            for m in range(2, len(g)):
                for k in range(len(g) - m + 1):
                    most[g[k : k + m]] = max(most[g[k : k + m]], f[g])
        kept = []
        for g in candidates:
            if 100 * most[g] < 80 * f[g]:
                score, k = min((2_000_000 * f[g] // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                kept.append((-score, -f[g], " ".join(g).encode(), f[g[:k]], f[g[k:]], *own[g][1:]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s, left, right) for r, (s, a, p, x, y, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    words = ["The", "of", "stone", "bird", "été", "x-y", "new", "york", "😀", "it's", "a b", "\x00", "\x01z"]
    out = [("".join(r.choice(words[: r.randint(3, 13)]) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b"]) for _ in range(r.randint(0, 60))), r.choice(["en", "en", "en", "fr", None, "und", ""])) for _ in range(250)]
    return [*out, (None, "en"), ("", "de"), (None, None), ("new york city hall " * 20_000, "en"), ("a a a a a a", "it"), out[0], out[0]]


def table(spark, rows):
    return spark.createDataFrame([(k, *r, "clash", "clash", "clash", "clash") for k, r in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize(("least", "top"), [(1, 10_000), (3, 40), (30, 2000)])
def test_same_as_plain(spark, rows, least, top):
    docs = table(spark, rows).repartition(5)
    assert sorted(tuple(r) for r in phrases.collocations(spark, docs, least=least, top=top).collect()) == plain(rows, least, top)


def test_joined_pairs_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(bloom, "CAPACITY", 0)
    assert sorted(tuple(r) for r in phrases.collocations(spark, table(spark, rows).repartition(3), least=4).collect()) == plain(rows, 4, 2000)


def test_empty_table_and_rare_words(spark):
    assert phrases.collocations(spark, table(spark, [])).collect() == []
    assert phrases.collocations(spark, table(spark, [("one two three", "en"), (None, None)])).collect() == []


def test_index_counts_and_extensions():
    r = random.Random(8)
    for size in (0, 1, 5, 400, 5000):
        seq = np.array([r.choice([0, 1, 2, 2, 3, 4, 5]) for _ in range(size)], np.int32)
        index = phrases.Index(seq)
        whole = [0, *seq.tolist(), 0]
        two = index.left(*index.single)
        three = index.right(*two)
        for found in (index.single, two, three, index.left(*three), index.right(*index.left(*two))):
            ids, ahead, behind, n = found
            m = ids.shape[1]
            at = [k for k in range(len(whole) - m + 1) if min(whole[k : k + m]) > 1]
            want = Counter(tuple(whole[k : k + m]) for k in at)
            assert dict(zip(map(tuple, ids.tolist()), n.tolist(), strict=True)) == want
            left, right = (Counter(tuple(whole[k : k + m]) for k in at if whole[k + d] > 0) for d in (-1, m))
            for g, x, y in zip(map(tuple, ids.tolist()), *(e.tolist() for e in index.extensions(ahead, behind, n)), strict=True):
                assert (x, y) == (left[g], right[g])


def test_score_of_large_counts_is_exact(spark):
    a, b = 10**14 + 7, 3 * 10**15 + 11
    key = 2 << 32 | 3
    candidates = spark.createDataFrame([(key, 0, a, 0, 0)], "k1 BIGINT, k2 BIGINT, a BIGINT, left BIGINT, right BIGINT")
    counts = spark.createDataFrame([(2 << 32, 0, b), (3 << 32, 0, a)], "k1 BIGINT, k2 BIGINT, f BIGINT")
    assert phrases.scored(candidates, counts).first()["score"] == 2_000_000 * a // (a + b)
