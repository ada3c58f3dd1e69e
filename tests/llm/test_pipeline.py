"""The corpus pipeline, stage by stage, on a small table with planted cases, and as a whole against plain versions."""

import hashlib
import random

import public_tokenizers
from test_numbered import plain_contamination, plain_groups, plain_spans, sentence, words_of

import corpus_pipeline
from calltrail.llm import pii
from calltrail.llm.common import materialize

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
PARTS = "the and ing tion of her wh sh ed".split()


def word(r):
    return "".join(r.choice(PARTS) for _ in range(r.randint(1, 3)))


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    r = random.Random(11)
    make = lambda n: " ".join(word(r) for _ in range(n))
    item = make(30)
    base = make(120).split()
    near = " ".join(w if k != 60 else "changed" for k, w in enumerate(base))
    texts = [" ".join(base), " ".join(base), near, f"{make(60)} {item} {make(60)}", item, f"{make(30)} me@site.org {make(30)}", None, "", *[make(50) for _ in range(40)]]
    spark.createDataFrame([(k, t, "en", "s", None if t is None else len(t)) for k, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), f"test-{name}")
        seen.append({x.doc_id: x for x in docs.collect()})
        assert name == "token_ids" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    clean = {3, 5, *range(8, len(texts))}
    assert set(seen[0]) == {0, 1, 2, 4} | clean
    assert set(seen[1]) == {0, 4} | clean
    assert set(seen[2]) == {0} | clean and item not in seen[2][3].text and seen[2][3].n_chars == len(seen[2][3].text)
    assert "<EMAIL>" in seen[3][5].text and "me@site.org" not in seen[3][5].text
    assert set(seen[4]) == set(seen[3]) and all(seen[3][k].text == texts[k] for k in clean - {3, 5})
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "personal_data", "token_ids"]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_whole_pipeline_is_the_plain_one(spark, tmp_path):
    import sentencepiece

    r = random.Random(21)
    vocabulary = [f"{a}{b}" for a in ("wa", "sto", "ri", "bi", "hou", "li", "gre", "un") for b in ("ter", "ne", "ver", "rd", "se", "ght")]
    make = lambda n: sentence(r, n, vocabulary)
    items = [(k, make(r.choice([6, 14, 30]))) for k in range(4)]
    texts = [make(r.randint(20, 120)) for _ in range(60)] + [None, "", "12 -- 34"]
    texts += [" ".join(w if k != 50 else "changed" for k, w in enumerate(t.split())) for t in texts[:6]] + [texts[7]] * 2
    texts += [f"{make(40)}, {items[k % 4][1].upper()}. {make(30 * (k % 3))}" for k in range(8)]
    texts += [f"{make(15)} me{k}@site.org {make(5)} +4420794609{k:02d} {make(5)}" for k in range(6)]
    spark.createDataFrame([(k, t, "en", f"s{k % 2}", None if t is None else len(t)) for k, t in enumerate(texts)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")

    rows = [(k, t) for k, t in enumerate(texts) if t and any(c.isalpha() for c in t)]
    rows = [row for k, row in enumerate(rows) if plain_groups(rows)[k] == k]
    kept = []
    for k, t in rows:
        n, hit, _, _ = plain_contamination(t, items)
        if hit * 2 > n:
            continue
        gone, windows = set(), {tuple(words_of(x)[i : i + 10]) for _, x in items for i in range(max(1, len(words_of(x)) - 9))}
        w = words_of(t)
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    gone |= set(range(i, i + size))
        at, places = 0, []
        for x in w:
            at = t.lower().index(x, at)
            places.append((at, at + len(x)))
            at += len(x)
        out, end = "", 0
        for i in sorted(gone):
            if i - 1 not in gone:
                out += t[end : places[i][0]]
            end = places[i][1]
        t = out + t[end:]
        out, end = "", 0
        for kind, a, b in sorted(plain_spans(t), key=lambda s: s[1]):
            out, end = f"{out}{t[end:a]}<{pii.KINDS[kind].upper()}>", b
        kept.append((k, out + t[end:]))
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted((k, len(ids := model.encode(t)), sha(",".join(map(str, ids))), sha(model.decode(ids))) for k, t in kept)
    got = sorted((x.doc_id, x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert 60 < len(got) < len(texts) and got == want
