"""The numbered operators against plain versions, on small tables with nulls, empty and long texts, ties and repeats."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from calltrail.llm import avi, bloom, decontam, langid, neardup, pieces, pii, queries, repeats, tokenfile, warc
from calltrail.llm.common import Memo, materialize, new_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, id STRING, digest STRING, kept INT, n_tokens STRING"


def sentence(r, n, words=("the", "of", "and", "reading", "water", "stone", "river", "bird", "house", "light", "green", "under", "over", "small")):
    return " ".join(r.choice(words) + r.choice(["", "", "s", "ing"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    r = random.Random(5)
    base = sentence(r, 150)
    words = base.split()
    near = " ".join(w if k % 60 else "changed" for k, w in enumerate(words))
    passage = sentence(r, 60)
    out = [None, "", base, base, near, sentence(r, 80) + " " + passage, passage + " " + sentence(r, 90), "x", "  two  spaces ", "\n\n", sentence(r, 9000), "a" * 700, "ééé 日本 😀 <s>", "mail a.b@c.org, +1 (555) 123-4567; 10.0.0.1, 4111 1111 1111 1111"]
    return out + [sentence(r, r.randint(1, 60)) for _ in range(30)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en" if k % 3 else None, f"src{k % 2}", len(t or ""), "clash", "clash", 1, "clash") for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[2], (None, None, None, None, None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r[key]].append(r)
    return out


def pairs(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


# --- tokenizers -----------------------------------------------------------------------------------------------------


def odd_texts():
    r = random.Random(1)
    letters = "ab e.,  \n\t▁é日本😀0123'-_<s>0x0A</ "
    return ["", "  foo", " ", "   a  b   ", "\n\n", "▁▁ x", "<s> </s> <unk> <0x0A>"] + ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(500)]


def test_merge_codec_is_the_librarys(docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    v = pieces.vocabulary(PIECES)
    for t in odd_texts():
        ids = model.encode(t)
        assert v.encode(t) == ids and v.decode(ids) == model.decode(ids)
    got = by_id(pieces.encode_digests(docs, PIECES), "id")
    for d, t in pairs(docs):
        ids = model.encode(t)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest())
        assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want for r in got[d])
    assert sum(map(len, got.values())) == docs.count()


def test_texts_of_a_batch_are_coded_as_the_libraries_do():
    import sentencepiece

    r = random.Random(3)
    parts = ["ab", "é", "ß", "the", "Water", ".", ",", ",", ";", "!?", "'s", "don't", "\n", "\t", "▁", "日本", "😀", "0123", "<s>", "-", "_", "\x01", "\u00a0", "<|endoftext|>", "###", "1.5", "…", "\r\n", "  "]
    some = [" ".join("".join(r.choices(parts, k=r.randint(1, 4))) for _ in range(r.randint(1, 12))) for _ in range(800)] + odd_texts() + ["a", " a", "a "]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [model.encode(t) for t in some]
    csv, back = pieces.TextCodec(pieces.PieceVocabulary(PIECES), 50).many(some)
    assert csv == [",".join(map(str, ids)) for ids in want] and back == [model.decode(ids) for ids in want]
    counter = pieces.Counter(pieces.PieceVocabulary(PIECES), 50)
    assert counter.many(some) == [counter(t) for t in some]
    words = tokenfile.WordIds(WORDS, 200)
    for at in range(0, len(some), 100):
        ids, n = words.encode(some[at : at + 100])
        found = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in some[at : at + 100]]
        assert n.tolist() == list(map(len, found)) and ids.tolist() == [i for f in found for i in f]


def test_whole_ids_agree_with_digests(docs):
    for r in pieces.encode_texts(docs.limit(12), PIECES).collect():
        assert r.decoded == pieces.vocabulary(PIECES).decode(r.ids)


def test_viterbi_counts_are_the_librarys(docs, empty):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    low = min(p.score for p in proto.pieces if p.type == 1 and p.score > pieces.NO_MERGE) - 1
    for p in proto.pieces:
        if p.type == 1:
            p.score = max(p.score, low)
    model = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    v = pieces.vocabulary(PIECES)
    for t in odd_texts():
        assert pieces.Counter(v)(t) == len(model.encode(t))
    got = by_id(pieces.count_tokens(docs, PIECES), "id")
    for d, t in pairs(docs):
        if len(t) < 2000:  # the library's 32-bit sums may round beyond
            assert {r.n_tokens for r in got[d]} == {len(model.encode(t))}
    assert pieces.count_tokens(empty, PIECES).count() == 0


def test_memo_keeps_its_bound_and_its_results():
    m = Memo(lambda k: k * 2, 3)
    assert [m[k] for k in "abcdabcd"] == [k * 2 for k in "abcdabcd"] and len(m) <= 3


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORDS)
    own = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = by_id(tokenfile.round_trip(spark, own, WORDS), "id")
    at = 0
    for d, t in sorted(pairs(own)):
        ids = [*model.encode(t, add_special_tokens=False).ids, 1]
        (r,) = got[d]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokenfile.round_trip(spark, empty, WORDS).count() == 0
    assert tokenfile.round_trip(spark, docs, WORDS).count() == docs.count()


def test_words_of_one_batch_outlive_a_full_memo():
    w = tokenfile.WordIds(WORDS, limit=4)
    r = random.Random(2)
    for _ in range(5):
        some = [sentence(r, 12) for _ in range(3)]
        want = [w.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        ids, n = w.encode(some)
        assert ids.tolist() == [i for x in want for i in x] and n.tolist() == list(map(len, want))


@pytest.mark.parametrize("counts", [{3: 1}, {0: 5, 9: 5}, {k: 2**k for k in range(30)}, {k: 1 for k in range(257)}])
def test_huffman_blocks(counts):
    lengths = np.zeros(max(counts) + 1, np.uint8)
    for k, n in tokenfile.limited_lengths(counts).items():
        lengths[k] = n
    assert lengths.max() <= 16 and sum(2.0 ** -int(n) for n in lengths if n) <= 1
    r = random.Random(3)
    ids = np.array([r.choice(list(counts)) for _ in range(1000)], np.int64)
    raw = tokenfile.pack_block([400, 0, 600], ids, lengths, tokenfile.canonical_codes(lengths))
    n, out = tokenfile.unpack_block(raw, tokenfile.decode_table(lengths))
    assert n.tolist() == [400, 0, 600] and (out == ids).all()


# --- near duplicates --------------------------------------------------------------------------------------------------


def multiset(t):
    w = t.lower().split()
    return collections.Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def similarity(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


def plain_groups(rows):
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [multiset(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or similarity(sets[i], sets[j]) >= 0.8:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def same_partition(a, b):
    return len(set(zip(a, b, strict=True))) == len(set(a)) == len(set(b))


def test_groups_are_the_plain_ones(spark, docs):
    rows = [r for r in pairs(docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]))]
    own = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r.id: r.group_id for r in neardup.groups(spark, own).collect()}
    assert same_partition([got[d] for d, _ in rows], plain_groups(rows))
    assert all(g <= d for d, g in got.items())


def test_hub_of_copies_and_copies_of_copies(spark):
    """Copies near their original only, far ones, and a chain of which each link holds."""
    r = random.Random(9)
    base = sentence(r, 150, [f"w{k}" for k in range(400)]).split()

    def edited(words, n):
        out = list(words)
        for k in r.sample(range(len(out)), n):
            out[k] = f"e{r.random()}"
        return out

    texts = [edited(base, r.choice([0, 1, 2, 3, 5, 9])) for _ in range(60)]
    chain = [base]
    for _ in range(6):
        chain.append(edited(chain[-1], 2))
    rows = [(k, " ".join(t)) for k, t in enumerate([*texts, *chain])]
    got = {x.id: x.group_id for x in neardup.groups(spark, spark.createDataFrame(rows, "doc_id BIGINT, text STRING")).collect()}
    assert same_partition([got[d] for d, _ in rows], plain_groups(rows))


def test_one_row_of_each_group_stays(spark, docs, empty):
    kept = neardup.keep_one(spark, docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 0 in ids and 1 not in ids and 2 in ids and 3 not in ids and 4 not in ids and None not in ids
    assert neardup.keep_one(spark, empty).count() == 0


def test_signatures_estimate_weighted_similarity():
    keys = np.arange(300, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a = (keys, np.where(np.arange(300) % 3 == 0, 5, 1))
    b = (keys, np.where(np.arange(300) % 3 == 0, 3, 2))
    sig = neardup.signatures([a, b, (keys[:0], np.zeros(0, np.int64))], 4096)
    assert abs((sig[0] == sig[1]).mean() - neardup.overlap(a, b)) < 0.04 and np.isinf(sig[2]).all()
    again = neardup.signatures([b], 4096)
    assert (again[0] == sig[1]).all()


# --- passages ---------------------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))


def plain_contamination(text, items):
    windows = collections.defaultdict(set)
    for name, t in items:
        w = words_of(t or "")
        for k in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[k : k + 10])].add(str(name))
    w, hit, found = words_of(text), set(), set()
    for n in {len(k) for k in windows}:
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in windows:
                found |= windows[tuple(w[k : k + n])]
                hit.update(range(k, k + n))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_contamination(spark, empty):
    r = random.Random(4)
    few = ("a", "b", "c")
    items = [(k, sentence(r, r.choice([3, 10, 11, 25]), few)) for k in range(6)] + [(7, None), (8, ""), (9, "ÉÉ x"), (9, "ÉÉ x")]
    texts = [None, "", "A-b, c!"] + [sentence(r, 60, few) for _ in range(20)] + [items[3][1].upper().replace(" ", "--"), "q ÉÉ X q"]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    for most in (decontam.MAX_WORDS, 40):  # one automaton, and several passes
        got = by_id(decontam.contamination(docs, bench, max_words=most), "id")
        for d, t in enumerate(texts):
            (x,) = got[d]
            assert (x.n_words, x.n_hit, x.n_items, x.items_sha256) == plain_contamination(t or "", items)
    assert decontam.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(empty, bench).count() == 0


def test_passages_are_cut(spark, docs):
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(0, f"Keep this. {item.upper()}! " + "and that " * 9, 5), (1, item, 5), (2, "clean", 5), (3, None, None)]
    own = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_chars BIGINT")
    bench = spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING")
    got = {r.doc_id: r for r in decontam.remove_contamination(spark, own, bench).collect()}
    assert got[0].text == "Keep this. ! " + "and that " * 9 and got[0].n_chars == len(got[0].text)
    assert 1 not in got and got[2].n_chars == 5 and got[3].text is None
    assert decontam.remove_contamination(spark, docs, bench).columns == docs.columns


def plain_repeats(texts):
    raws = [(t or "").encode() for t in texts]
    seen = collections.Counter(r[i : i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - 199):
            if seen[r[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("how", ["plain", "hot", "all hot", "small pieces", "joined"])
def test_repeated_bytes(spark, docs, empty, monkeypatch, how):
    if how == "hot":
        monkeypatch.setattr(repeats, "GROUP", 2)
    if how == "all hot":
        monkeypatch.setattr(repeats, "GROUP", 0)
    if how == "joined":
        monkeypatch.setattr(bloom, "CAPACITY", -1)
    r = random.Random(6)
    shared = sentence(r, 60)
    rows = [t for _, t in pairs(docs.where("n_chars IS NULL OR n_chars < 3000"))] + [f"{sentence(r, 9)} {shared}{sentence(r, 9)}" for _ in range(5)] + [shared[:200], shared[:199], "ab" * 300, "é" * 150]
    own = spark.createDataFrame(list(enumerate(rows)), "doc_id BIGINT, text STRING")
    got = by_id(repeats.remove_repeats(spark, own), "id")
    for d, want in enumerate(plain_repeats(rows)):
        (x,) = got[d]
        assert (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) == want
    if how == "plain":
        assert repeats.remove_repeats(spark, empty).count() == 0


def test_interleave_of_shards_gives_common_lengths_and_repeats():
    r = random.Random(4)
    shards = []
    for _ in range(3):
        raw = b"".join(r.choice([b"ab" * 60, bytes(r.choices(b"ab", k=40)), b"c" * 210, b"xyz" * 80]) for _ in range(12))
        shards.append((np.frombuffer(raw, np.uint8), np.arange(len(raw) - 199)))
    repeated, common = repeats.interleave(shards, [np.zeros(len(s), bool) for _, s in shards])
    windows = [[raw.tobytes()[a : a + 200] for a in starts] for raw, starts in shards]
    counts = collections.Counter(w for part in windows for w in part)
    for part, flags in zip(windows, repeated, strict=True):
        assert flags.tolist() == [counts[w] > 1 for w in part]
    everything = [w for part in windows for w in part]
    for w, n in zip(everything, np.concatenate(common).tolist(), strict=True):
        if counts[w] == 1:  # two windows of the interval that it left last end alike so far
            assert n == 0 or sum(v.endswith(w[-n:]) for v in everything) > 1
    place, symbol, back, same = repeats.transform(shards[0][0])
    raw = shards[0][0].tobytes() + b"\0"
    order = sorted(range(len(raw)), key=lambda k: raw[k : k + 200].ljust(200, b"\0"))
    assert [raw[k : k + 200].ljust(200, b"\0") for k in np.argsort(place)] == [raw[k : k + 200].ljust(200, b"\0") for k in order]
    at, walked = place[len(raw) - 1], b""
    for _ in range(len(raw) - 1):
        walked, at = bytes([symbol[at]]) + walked, back[at]
    assert walked == raw[:-1]


def test_runs_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 512)
    r = random.Random(8)
    texts = [sentence(r, n).encode() for n in (0, 30, 60, 900, 40)]
    seen = sorted((t, a + k) for text, at, size, _ in repeats.runs(texts) for t, a, n in zip(text.tolist(), at.tolist(), size.tolist(), strict=True) for k in range(n))
    assert seen == [(t, k) for t, raw in enumerate(texts) for k in range(max(0, len(raw) - 199))]


# --- personal data ----------------------------------------------------------------------------------------------------


def plain_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        return sum((2 * int(c) - 9 * (int(c) > 4)) if k % 2 else int(c) for k, c in enumerate(reversed(s))) % 10 == 0

    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_are_the_patterns():
    r = random.Random(7)
    letters = "ab1234567890.@+- ()_%\n"
    for _ in range(4000):
        t = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t)
    assert pii.base_spans("x 4111-1111-1111-1111 +44 20 7946 0958 a@b.co@d.ef 1.2.3.4.5 0001.02.3.255") == plain_spans("x 4111-1111-1111-1111 +44 20 7946 0958 a@b.co@d.ef 1.2.3.4.5 0001.02.3.255")


def test_long_runs_take_linear_time():
    for t in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "@" * 100_000, "+1" + "(" * 100_000):
        pii.base_spans(t)


def test_spans_and_redaction(spark, docs, empty, texts):
    got = by_id(pii.find_spans(docs), "id")
    for d, t in pairs(docs):
        base = plain_spans(t)
        for x in got[d]:
            assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
            assert x.base_sha256 == hashlib.sha256(",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
            assert base or not x.spans
    clean = by_id(pii.redact_documents(docs))
    assert clean[13][0].text == "mail <EMAIL>, <PHONE>; <IP>, <CARD>" and clean[13][0].n_chars == len(clean[13][0].text)
    assert clean[0][0].text is None and clean[2][0].text == texts[2]
    assert pii.redact_documents(docs).columns == docs.columns and pii.find_spans(empty).count() == 0


def test_messages_carry_labels_to_other_mentions():
    text = "Call +1 555 123 4567 now. " + "word " * 50 + "again 15551234567 or ticket 20240117."
    field = pii.SkipChainField(np.zeros((pii.N_FEATURES, 5)), np.zeros((5, 5)))
    field.weights[0, 0] = 1.0
    whole = "Call +15551234567 now. " + text[25:]
    ((base, added),) = pii.label_texts([whole], field)
    assert [whole[a:b] for k, a, b in added if k == 3] == ["15551234567"]
    assert pii.label_texts([whole, text], field)[0] == (base, added)


# --- language, archives, media ------------------------------------------------------------------------------------------


def test_language_held_out(spark):
    r = random.Random(3)
    parts = {"en": "the and ing tion of her wh sh ed".split(), "fr": "le de eau ment oui ais que ch é".split(), "de": "der und sch ung ein lich keit ü ber".split()}
    make = lambda x: " ".join("".join(r.choice(parts[x]) for _ in range(r.randint(1, 3))) for _ in range(30))
    rows = [(k, make(x), x if k < 240 else None, f"s{k % 4}") for k, x in enumerate(r.choices(list(parts), k=300))]
    truth = [next(x for x in parts if rows[k][1].split()[0].startswith(tuple(parts[x]))) for k in range(300)]
    names = r.choices(list(parts), k=300)
    rows = [(k, make(x), x if k < 240 else None, f"s{k % 4}") for k, x in enumerate(names)]
    rows += [(900, None, "en", "s0"), (901, "", "en", "s0"), (902, "### 12 $$", None, None), (903, "qxz jvk wqp zzxq kkjw vvqz xqj wzk jjq", None, None)]
    got = {x.doc_id: x for x in langid.fuse(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING")).collect()}
    held = [k for k in range(240, 300)]
    assert sum(got[k]["__language"] == names[k] for k in held) >= 0.97 * len(held) and len(truth) == 300
    assert sum(got[k]["__language"] == names[k] for k in range(240)) >= 235
    assert not any(got[k]["__keep"] for k in (900, 901, 902)) and len(got) == len(rows)


def test_fusion_is_the_plain_sum(spark):
    """Every term by hand: trigrams, declaration, suffix, and host counts without the row's own declaration."""
    r = random.Random(6)
    rows = [(k, f"https://{r.choice(['a.x', 'b.x', 'c.y'])}.{r.choice(['de', 'uk', 'org'])}/p", r.choice(["en", "de-AT", None, "fr"]), " ".join(r.choice(["the", "der", "le", "und", "and", "et"]) for _ in range(6))) for k in range(60)]
    df = spark.createDataFrame([(*x, "clash", "clash") for x in rows], "page_id BIGINT, url STRING, declared STRING, text STRING, __host STRING, __prior STRING")
    model = langid.fit_trigrams(df.selectExpr("text", "substring_index(declared, '-', 1) AS lang"))
    names = model.languages
    host = lambda u: u.split("/")[2]
    said = lambda d: d and d.split("-")[0]
    got = {x.page_id: x for x in langid.fuse(df, declared_col="declared", host_col=None, url_col="url").collect()}
    for k, url, declared, text in rows:
        others = [(host(u), said(d)) for j, u, d, _ in rows if j != k and d]
        count = lambda x, keep: sum(d == x and keep(h) for h, d in others)
        known = any(host(u) == host(url) and d for _, u, d, _ in rows)
        logs = []
        for i, x in enumerate(names):
            s = langid.TEMPER * float(model.scores(text)[i])
            if x == langid.UNKNOWN:
                logs.append(s + (np.log(0.01) if known else -np.log(len(names))) + np.log(1 / (len(names) - 1)))
                continue
            base = (count(x, lambda h: True) + 1) / (len(others) + len(names) - 1)
            domain = host(url).split(".")[-2:]
            in_domain, on_host = (lambda h: h.split(".")[-2:] == domain), (lambda h: h == host(url))
            total = lambda keep: sum(keep(h) for h, _ in others)
            p = (count(x, in_domain) + 20 * base) / (total(in_domain) + 20)
            p = (count(x, on_host) + 20 * p) / (total(on_host) + 20)
            s += np.log(p) if known else -np.log(len(names))
            for value, trust in ((said(declared), 0.9), (langid.SUFFIX_LANGUAGE.get(url.split("/")[2].split(".")[-1]), 0.7)):
                if value in names[:-1]:
                    s += np.log(trust if value == x else (1 - trust) / (len(names) - 2))
            logs.append(s)
        p = np.exp(np.array(logs) - max(logs))
        assert got[k]["__language"] == names[int(np.argmax(p))] and abs(got[k]["__posterior"] - p.max() / p.sum()) < 1e-6
        assert got[k]["__host"] == "clash" and got[k]["__prior"] == "clash"


def test_fits_keep_their_bounds(spark):
    """A third of all rows is one text, whatever its hash."""
    rows = [(f"the text {k}", "en") for k in range(60)] + [(t, "en") for t in ("hot one", "hot two", "hot three") for _ in range(50)] + [("x", f"l{k}") for k in range(300)]
    df = spark.createDataFrame(rows, "text STRING, lang STRING")
    model = langid.fit_trigrams(df, rows=5)
    assert len(model.languages) == langid.MOST_LANGUAGES + 1 and model.languages[0] == "en"
    one = langid.fit_trigrams(df.where("lang = 'en'"), rows=5)
    whole = langid.fit_trigrams(df.where("lang = 'en'").distinct(), rows=5)
    assert np.array_equal(one.table, whole.table)


def test_priors_are_smoothed_counts(spark, empty):
    rows = [("a.x.org", "en")] * 30 + [("b.x.org", "fr")] * 10 + [("c.y.org", None), (None, "en"), ("c.y.org", "xx")]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "host STRING, declared STRING")
    got = {r.host: r["__prior"] for r in langid.host_priors(df, ["en", "fr"], F.col("host"), F.col("declared")).collect()}
    base = [(30 + 1) / 42, (10 + 1) / 42]
    domain = [(30 + 20 * base[0]) / 60, (10 + 20 * base[1]) / 60]
    want = np.log([(30 + 20 * domain[0]) / 50, (0 + 20 * domain[1]) / 50])
    assert np.allclose(got["a.x.org"][:2], want) and set(got) == {"a.x.org", "b.x.org"}
    assert langid.fuse(empty).count() == 0


def test_pages_use_markup_and_address(spark):
    rows = [(k, "water stone river bird" if k % 2 else "wasser stein fluss vogel", "en-GB" if k % 2 else "DE", f"https://h{k % 3}.{'uk' if k % 2 else 'de'}/p") for k in range(40)]
    df = spark.createDataFrame(rows, "page_id BIGINT, html STRING, declared STRING, url STRING")
    got = langid.fuse(df, text_col="html", declared_col="declared", host_col=None, url_col="url").collect()
    assert all(r["__language"] == ("en" if r.page_id % 2 else "de") for r in got)


def test_markup_is_read_and_taken_out(spark):
    pages = {
        '<!-- <html lang="xx"> --><HTML class="a>b" LANG=\'fr-CA\'><p title="x">l&eacute;s</p><script>var t="</p>";</script>ici': ("fr", "lés ici"),
        '<html data-lang="xx"><meta content="de-AT" http-equiv="Content-Language">ja': ("de", "ja"),
        "<html><meta property=og:locale content=es_MX>si <b": ("es", "si"),
        "<html>a < b<style>p{}": (None, "a < b"),
        "lang='en'": (None, "lang='en'"),
    }
    df = spark.createDataFrame([*enumerate(pages), (9, None)], "page_id BIGINT, html STRING")
    got = {r.page_id: r for r in langid.with_page_evidence(df).collect()}
    assert [(got[k].declared, " ".join(got[k].text.split())) for k in range(5)] == list(pages.values())
    assert got[9].declared is None and got[9].text is None
    assert len(langid.page_text("<a " * 100_000 + "<!--" * 100_000 + "<script" * 100_000)) < 500_000


def test_language_query_covers_pages(spark, tmp_path):
    spark.createDataFrame([(0, "the water", "en", "s"), (0, None, None, None)], "doc_id BIGINT, text STRING, lang STRING, source STRING").write.parquet(f"{tmp_path}/documents.parquet")
    body = ["der wasser stein fluss vogel", "the water stone river bird"]
    rows = [(k, f"https://a.h{k % 2}.{('de', 'uk')[k % 2]}/p", f"<html lang='{('de', 'en-GB')[k % 2]}'><p>{body[k % 2]}</p>") for k in range(20)]
    rows += [(20, "https://b.h0.de/", "<p>er"), (21, "https://b.h1.uk/", "<p>er"), (22, "no address", None)]
    spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op6_language_id(spark, str(tmp_path)).collect()
    got = {r.page_id: r.language for r in found if r.page_id is not None}
    address = [(r.language, r.posterior) for r in found if r.page_id in (20, 21)]
    assert len(found) == len(rows) + 2 and sum(r.page_id is None for r in found) == 2
    assert [got[k] for k in range(20)] == ["de", "en"] * 10 and got[22] == "und" and len(set(address)) == 2


def test_archives(spark, empty):
    r = random.Random(2)
    html = [f"<html><body>{sentence(r, 40)}</body></html>" for _ in range(30)] + [None, "", "é" * 70_000]
    rows = [(k, f"http://h/{k}\r\nX: y" if k % 5 == 0 else None, h) for k, h in enumerate([*html, html[3], html[3], ""])]
    rows += [rows[4], (None, "u", html[5]), (None, "u", "alone")]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    got = by_id(warc.round_trip(spark, pages), "page_id")
    first = {}
    for k, _, h in sorted((x for x in rows if x[0] is not None)):
        first.setdefault(h or "", k)
    for k, _, h in rows:
        if k is None:
            continue
        raw = (h or "").encode()
        for x in got[k]:
            assert (x.payload_bytes, x.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
            assert (x.record_type, x.refers_to) == (("response", None) if first[h or ""] == k else ("revisit", first[h or ""]))
    assert sum(map(len, got.values())) == len(rows) and len(got[None]) == 2
    folder = new_path(spark, "warc-test")
    records = warc.read_archives(materialize(warc.write_archives(spark, pages, folder), "groups"), folder).collect()
    assert len({x.record_id for x in records}) == len(rows)
    responses = {(x.target_uri, x.payload_digest) for x in records if x.record_type == "response"}
    assert all((x.refers_to_uri, x.payload_digest) in responses for x in records if x.record_type == "revisit")
    assert warc.round_trip(spark, spark.createDataFrame([], "page_id BIGINT, url STRING, html STRING")).count() == 0


def test_media_round_trip(docs, empty):
    r = random.Random(1)
    payloads = [avi.payload_of(t) for t in ("", "x", "ÿ" * 40, "a" * 64)] + [bytes(range(256)) * 3, r.randbytes(6400), b"\xff" * 1024]
    for p, (frames, n, fps) in zip(payloads, avi.read_many(avi.write_many(payloads)), strict=True):
        assert n == len(p) and frames.tobytes()[:n] == p and not any(frames.tobytes()[n:]) and fps == avi.FPS
    got = by_id(avi.media_digests(avi.to_media(docs)), "id")
    for d, t in pairs(docs):
        p = avi.payload_of(t)
        for x in got[d]:
            assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(t.encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert len({x.media_sha256 for x in (*got[2], *got[3])}) == 1 and avi.media_digests(avi.to_media(empty)).count() == 0


def test_shots_cut_where_pictures_change(docs):
    frames = np.concatenate([np.full((6, 16, 64), 20, np.uint8), np.full((9, 16, 64), 200, np.uint8), np.full((4, 16, 64), 90, np.uint8)])
    assert [(a, b) for a, b, _ in avi.shots(frames)] == [(0, 6), (6, 15), (15, 19)]
    rows = avi.clips(avi.to_media(docs.limit(3))).collect()
    assert all(r.start_ms < r.end_ms for r in rows) and {r.id for r in rows} == {0, 1, 2}
    with pytest.raises(ValueError, match="not an AVI"):
        avi.parse_avi(b"nothing")


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    f = bloom.build(keys, "key", 5000)
    own = np.array([r.key for r in keys.collect()], np.int64)
    assert f(own).all() and f(own + 1).mean() < 0.05 and bloom.build(keys, "key", bloom.CAPACITY + 1) is None
