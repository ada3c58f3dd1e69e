"""The numbered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from calltrail.llm import avi, decontam, divergence, langid, maintext, neardup, phrases, pieces, pii, repeats, tokenfile, warc
from calltrail.llm.common import materialize, table

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens of each document by the best-scored segmentation. Null and empty texts have 0; repeated rows keep their rows."""
    return pieces.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)).withColumnRenamed("id", "doc_id")


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """class_id: the smallest doc_id of the document's near-duplicate group; text_id: of its exact copies. Nulls are empty
    texts, one group; repeated rows keep their rows."""
    return neardup.groups(spark, table(spark, sf_dir, "documents")).selectExpr("id AS doc_id", "group_id AS class_id", "text_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in each document. Null texts have no words, repeated rows keep their rows; see contamination() for items."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op4_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids and of the text decoded from them. Null is the empty text; repeated rows keep their rows."""
    return pieces.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES)).withColumnRenamed("id", "doc_id")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans, and with them those that the field adds. Null is the empty text; repeated rows keep their rows."""
    return pii.find_spans(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, then one for each page: page_id is null for documents, doc_id for pages."""
    columns = ["__language AS language", "round(__posterior, 6) AS posterior", "__keep AS keep"]
    docs = langid.fuse(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    own = materialize(langid.with_page_evidence(table(spark, sf_dir, "pages").select("page_id", "url", "html")), "page-text")
    pages = langid.fuse(own, declared_col="declared", host_col=None, url_col="url")
    return docs.selectExpr("doc_id", *columns, "CAST(NULL AS BIGINT) AS page_id").unionByName(pages.selectExpr("CAST(NULL AS BIGINT) AS doc_id", *columns, "page_id"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place in the token files and what they hold of it. Null is the empty text; ties go by number of ids, then ids."""
    return tokenfile.round_trip(spark, table(spark, sf_dir, "documents"), public_tokenizers.path(WORDS)).withColumnRenamed("id", "doc_id")


def op8_warc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each page read back from the archives. Null html is empty; null ids revisit the first page of their payload."""
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


def op9_avi_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document stored as AVI. Null is the empty text; equal texts have equal values, repeated rows keep their rows."""
    return avi.media_digests(avi.to_media(table(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without repeated 200-byte strings. Null is the empty text; a text that stands twice goes whole if it has 200 bytes."""
    found = repeats.remove_repeats(spark, table(spark, sf_dir, "documents"))
    return found.selectExpr("id AS doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two to four words. Null langs are `und`, null texts empty; repeated rows count each time."""
    return phrases.collocations(spark, table(spark, sf_dir, "documents")).drop("left", "right")


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of each page. Null html is empty, pages without an article have the empty text; repeated rows keep their rows."""
    return maintext.main_text(table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergences of each language's sources by pairs, and each source's outstanding terms. Null texts, langs and sources are ''."""
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_decontamination": op3_decontamination,
    "op4_piece_codec": op4_piece_codec,
    "op5_personal_data": op5_personal_data,
    "op6_language_id": op6_language_id,
    "op7_token_files": op7_token_files,
    "op8_warc_files": op8_warc_files,
    "op9_avi_media": op9_avi_media,
    "op10_repeated_bytes": op10_repeated_bytes,
    "op11_phrases": op11_phrases,
    "op12_main_text": op12_main_text,
    "op13_source_divergence": op13_source_divergence,
}

#: Near duplicates by comparing all texts that share a shingle, and classes by following links.
_NEAR = r"""
WITH RECURSIVE t AS (SELECT coalesce(text, '') AS x, min(doc_id) AS text_id FROM documents GROUP BY 1),
w AS (SELECT text_id, list_filter(regexp_split_to_array(lower(x), '\s+'), lambda y: y <> '') AS w FROM t),
k AS (SELECT text_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS k FROM w WHERE len(w) > 0),
s AS (SELECT text_id, array_to_string(w[k:k + 4], ' ') AS g, count(*) AS c FROM k GROUP BY 1, 2),
n AS (SELECT text_id, sum(c) AS n FROM s GROUP BY 1),
p AS (SELECT a.text_id AS u, b.text_id AS v, sum(least(a.c, b.c)) AS m FROM s a JOIN s b ON a.g = b.g AND a.text_id <> b.text_id GROUP BY 1, 2),
e AS (SELECT u, v FROM p JOIN n nu ON nu.text_id = u JOIN n nv ON nv.text_id = v WHERE CAST(m AS DOUBLE) / CAST(nu.n + nv.n - m AS DOUBLE) >= 0.8),
r AS (SELECT text_id AS a, text_id AS b FROM t UNION SELECT r.a, e.v FROM r JOIN e ON e.u = r.b),
c AS (SELECT a, min(b) AS class_id FROM r GROUP BY 1)
SELECT doc_id, class_id, text_id FROM documents d JOIN t ON t.x = coalesce(d.text, '') JOIN c ON c.a = t.text_id"""

#: Windows of documents joined to windows of items, by length.
_LEAKS = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS win FROM i, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS u(k) WHERE len(w) > 0),
dk AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw)),
dw AS (SELECT rid, n, k, array_to_string(w[k:k + n - 1], ' ') AS win FROM dk),
h AS (SELECT rid, k, n, item FROM dw JOIN iw USING (n, win)),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM h) GROUP BY 1),
hi AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)"""

#: Payload digests in base32, five hexadecimal digits at a time.
_ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), x AS (SELECT *, sha1(h) AS d, min(page_id) OVER (PARTITION BY h) AS first FROM p),
v AS (SELECT *, list_transform(range(8), lambda g: list_sum(list_transform(range(5), lambda k: CAST((strpos('0123456789abcdef', substr(d, CAST(g * 5 + k + 1 AS BIGINT), 1)) - 1) * power(16, 4 - k) AS BIGINT)))) AS v FROM x)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(v, lambda b: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST(b AS BIGINT) >> s) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM v"""

#: All 200-byte strings by digest, cut from pieces of 699 bytes; those that repeat, put together where they touch, go.
_REPEATS = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT rid, o, substr(h, 2 * o + 1, 1398) AS x FROM (SELECT rid, h, unnest(range(0, greatest(len(h) // 2 - 199, 0), 500)) AS o FROM d)),
w AS MATERIALIZED (SELECT rid, o + k AS k, md5_number(substr(x, 2 * k + 1, 400)) AS win FROM (SELECT rid, o, x, unnest(range(0, len(x) // 2 - 199)) AS k FROM c)),
n AS (SELECT win FROM w GROUP BY 1 HAVING count(*) > 1),
s AS (SELECT rid, k, coalesce(k > lag(k) OVER (PARTITION BY rid ORDER BY k) + 200, true) AS starts FROM w SEMI JOIN n USING (win)),
r AS (SELECT rid, min(k) AS a, max(k) + 200 AS b FROM (SELECT rid, k, sum(CAST(starts AS INTEGER)) OVER (PARTITION BY rid ORDER BY k) AS run FROM s) GROUP BY rid, run),
p AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM r),
g AS (SELECT rid, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM p JOIN d USING (rid) GROUP BY 1)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN g USING (rid)"""

#: All phrases of one to four words by grouping; cuts and longer candidates by joins on lists of words.
_PHRASES = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY 1),
k AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM w, unnest(range(1, 5)) AS u(m)),
f AS (SELECT lang, w[k:k + m - 1] AS g, count(*) AS f FROM k GROUP BY 1, 2 HAVING count(*) >= 30),
c AS (SELECT lang, g, f AS a, len(g) AS m FROM f WHERE len(g) > 1),
i AS (SELECT lang, m, a, g, unnest(range(2, m)) AS s FROM c),
j AS (SELECT lang, a, g[b:b + s - 1] AS g FROM (SELECT *, unnest(range(1, m - s + 2)) AS b FROM i)),
x AS (SELECT lang, g, max(a) AS most FROM j GROUP BY 1, 2),
u AS (SELECT c.* FROM c LEFT JOIN x USING (lang, g) WHERE most IS NULL OR 100 * most < 80 * a),
t AS (SELECT lang, g, a, m, unnest(range(1, m)) AS k FROM u),
s AS (SELECT t.lang, t.g, a, k, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (l.f + r.f) AS BIGINT) AS score FROM t JOIN f l ON l.lang = t.lang AND l.g = t.g[1:k] JOIN f r ON r.lang = t.lang AND r.g = t.g[k + 1:m]),
b AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= 2000"""

#: The supplied pages hold one article element of paragraphs and a heading, and these references.
_ARTICLES = r"""
WITH a AS (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's'), '</?(?:p|h1)>') AS parts FROM pages),
b AS (SELECT page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t"""

#: Each source's share of each kept term, then all pairs of a term's shares.
_AUDIT = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT rid) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
n AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 2) // (coalesce(n, 0) + 2 * v) AS p
    FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = g.lang AND n.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(c) + 2) // (sum(sum(c)) OVER (PARTITION BY lang) + 2 * v) AS q FROM c JOIN v USING (lang) GROUP BY lang, term, v),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
    UNION ALL SELECT p.lang, source, 'term', p.term, (p - q) * (p - q) // (p + q) FROM p JOIN l USING (lang, term) WHERE c > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM o WHERE part = 'pair' OR rank <= 10"""

#: The others have no SQL: merges, Viterbi paths, fields, likelihoods, codes of token ids and pictures.
ORACLE_SQL: dict[str, str] = {"op2_near_duplicates": _NEAR, "op3_decontamination": _LEAKS, "op8_warc_files": _ARCHIVES, "op10_repeated_bytes": _REPEATS, "op11_phrases": _PHRASES, "op12_main_text": _ARTICLES, "op13_source_divergence": _AUDIT}
