"""Items in several automata give what they give in one."""

import random

from calltrail.llm import decontam


def test_parts_give_what_one_automaton_gives(spark):
    r = random.Random(8)
    make = lambda n: [r.choice("abcdefgh") + str(r.randint(0, 40)) for _ in range(n)]
    base = make(60)
    items = [(k, " ".join(base[4 * k : 4 * k + 14])) for k in range(10)] + [(20, " ".join(make(5))), (21, " ".join(make(30)))]
    texts = [" ".join(make(40) + base[a : a + n] + make(40)) for a, n in ((0, 14), (0, 30), (2, 40), (0, 54), (10, 20))]
    texts += [" ".join(make(a) + base[:50] + make(b)) for a, b in ((30, 10), (10, 10), (40, 40))]
    # what a first part's cut would leave side by side is an item of another part
    left, right = make(6), make(6)
    items.append((30, " ".join(left + right)))
    texts += [" ".join(make(20) + left + base[:14] + right + make(20)), None, ""]
    rows = [(k % 4 if k % 3 else None, t, None if t is None else len(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame([*rows, rows[0], rows[0]], "doc_id BIGINT, text STRING, n_chars BIGINT")
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    plain = lambda df: sorted(map(repr, df.collect()))
    assert len(decontam.item_parts(bench, max_words=60)) > 3
    cut = [plain(decontam.remove_contamination(spark, docs, bench, max_words=m)) for m in (decontam.MAX_WORDS, 60)]
    hit = [plain(decontam.contamination(docs, bench, max_words=m)) for m in (decontam.MAX_WORDS, 60)]
    assert cut[0] == cut[1] and hit[0] == hit[1] and len(hit[0]) == len(rows) + 2 > len(cut[0])
