"""Language ID by Bayesian evidence fusion.

Evidence on a text: byte-trigram likelihoods, the language its source declares, its address suffix, and a prior of its
host. Host priors are grouped counts of declared languages over all rows, each level drawn towards the level above it:
host, registered domain, all rows. A row's own declaration is evidence of its own and is left out of its host's counts.
The log terms add up; a class "und" of unigram bytes stands for what is no language.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calltrail.llm.common import ids_and_texts, unused, worker_state

BUCKETS = 1 << 16
#: Different texts of one language that the trigram model is fitted on, at most; those of the smallest hashes are taken.
FIT_ROWS = 2000
#: Languages of the model, at most: the most declared ones. Others count as no declaration.
MOST_LANGUAGES = 200
#: Host priors are broadcast up to this many hosts, and joined by shuffles beyond.
BROADCAST_HOSTS = 20_000
#: Weight of the level above in a level's counts.
STRENGTH = 20.0
#: Chance that a declared language, or an address suffix, is the right one.
TRUST_DECLARED, TRUST_SUFFIX = 0.9, 0.7
#: A text's trigrams overlap, so their evidence counts for less than the sum says.
TEMPER = 0.3
#: Country suffixes that speak for one language.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en"}
UNKNOWN = "und"
#: log of the prior of no language.
NO_LANGUAGE = float(np.log(0.01))
#: What is no text of a page: comments, scripts and styles, to the end where they are not closed; then tags.
_HIDDEN = r"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)"
_TAG = re.compile(r"""<[a-zA-Z/!?](?:[^<>"']++|"[^"]*"|'[^']*')*+>?""")
_HIDDEN_TEXT = re.compile(_HIDDEN)


def _grams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of the lower-cased text; digits and marks all count as spaces."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    letter = (raw >= 128) | ((raw >= 97) & (raw <= 122))
    raw = np.where(letter, raw, np.uint8(32)).astype(np.uint32)
    three = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    three = three[(raw[1:-1] != 32) | (raw[2:] != 32)]  # runs of marks say nothing
    return ((three * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


class TrigramModel:
    """log P(trigram | language) by bucket, and the class of unknown text, whose letters come in any order."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = [*languages, UNKNOWN]
        seen = int((counts.sum(axis=0) > 0).sum())
        known = np.log((counts + 0.1) / (counts.sum(axis=1, keepdims=True) + 0.1 * (seen + 1)))
        flat = np.full(BUCKETS, -np.log(max(1, min(BUCKETS, 4 * seen))))
        self.table = np.ascontiguousarray(np.vstack([known, flat]).T.astype(np.float32))

    def scores(self, text: str) -> np.ndarray:
        grams = _grams(text)
        if not len(grams):
            return np.zeros(len(self.languages), np.float32)
        return np.add.reduce(self.table[grams], axis=0, dtype=np.float64)


def fit_trigrams(docs: DataFrame, text_col: str = "text", label_col: str = "lang", rows: int = FIT_ROWS) -> TrigramModel:
    """Counts of trigrams by label over at most `rows` different texts of each label, summed on the executors.

    What reaches the driver has one row for a label and bucket, of MOST_LANGUAGES labels at most; ties go to the lesser
    name. Rows without label or text do not count, and repeated texts count once.
    """
    own = docs.select(F.col(label_col).cast("string").alias("label"), F.col(text_col).cast("string").alias("text")).where("label is not null and text is not null")
    h = F.xxhash64("text")
    found = own.groupBy("label").agg(F.count("*").alias("n"), F.approx_count_distinct(h).alias("texts")).orderBy(F.desc("n"), "label").limit(MOST_LANGUAGES).collect()
    sizes = {r["label"]: max(1, r["texts"]) for r in found}
    spot = F.pmod(h, F.lit(1 << 20))
    share = reduce(lambda c, x: c.when(F.col("label") == x, F.lit(int((1 << 20) * min(1.0, 4 * rows / sizes[x])))), sizes, F.when(F.lit(False), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.pmod("h", F.lit(1 << 20)), "h"))
    few = own.where(spot <= share).select("label", h.alias("h")).distinct().withColumn("place", place).where(F.col("place") <= rows).select("label", "h")
    chosen = F.broadcast(few)  # hashes alone: MOST_LANGUAGES times `rows` of them at most
    sample = own.withColumn("h", h).join(chosen, ["label", "h"]).groupBy("label", "h").agg(F.min("text").alias("text")).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            labels, texts = ids_and_texts(batch)
            for label, text in zip(labels, texts, strict=True):
                if label not in total:
                    total[label] = np.zeros(BUCKETS, np.int64)
                np.add(total[label], np.bincount(_grams(text), minlength=BUCKETS), out=total[label])
        for label, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["label", "bucket", "n"])

    found = sample.mapInArrow(run, "label string, bucket long, n long").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sizes)
    counts = np.zeros((len(languages), BUCKETS))
    for i, x in enumerate(languages):
        part = found[found["label"] == x]
        counts[i, part["bucket"].to_numpy(np.int64)] = part["n"].to_numpy(np.float64)
    return TrigramModel(languages, counts)


def text_scores(docs: DataFrame, model: TrigramModel, text_col: str = "text") -> DataFrame:
    """docs with a column __scores: log likelihood by language. Texts go to Python and back as scores only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def score(text: pd.Series) -> pd.Series:
        worker_state(("languages",), dict)  # lets go of what another kind of task has kept
        machine = shared.value
        return pd.Series([machine.scores(t or "").tolist() for t in text])

    return docs.withColumn("__scores", score(F.col(text_col).cast("string")))


def page_text(page: str) -> str:
    """Text of a page without markup; a tag stands for a space, entities for their characters."""
    return html.unescape(_TAG.sub(" ", _HIDDEN_TEXT.sub(" ", page)))


def markup_language(page: Column) -> Column:
    """Main language that a page declares: <html lang>, else <meta> content-language or og:locale; null for none."""
    seen = F.regexp_replace(page, _HIDDEN.replace(r"\Z", r"\z"), " ")
    value = r"""\s*=\s*["']?\s*([a-zA-Z]+)"""
    content = rf"\scontent{value}"
    named = r"""\s(?:http-equiv|name|property)\s*=\s*["']?\s*(?:content-language|language|og:locale)\b"""
    other = r"""(?:\s+[^\s<>"'=]++(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s<>"']+))?){0,200}?"""  # attributes before it; their loop recurses in the JVM
    patterns = (rf"(?i)<html{other}\s+(?:xml:)?lang{value}", rf"(?i)<meta\b(?=[^<>]*{named})[^<>]*?{content}")
    return F.lower(F.coalesce(*[F.nullif(F.regexp_extract(seen, p, 1), F.lit("")) for p in patterns]))


def with_page_evidence(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """pages with text (without markup) and declared (language of the markup) in place of html_col."""

    @F.pandas_udf("string")
    def plain(page: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else page_text(p) for p in page], dtype=object)

    page = F.col(html_col).cast("string")
    return pages.withColumn("declared", markup_language(page)).withColumn("text", plain(page)).drop(html_col)


def domain_of(host: Column) -> Column:
    """The last two labels of a host name."""
    return F.substring_index(host, ".", -2)


def host_priors(docs: DataFrame, languages: list[str], host: Column, declared: Column) -> DataFrame:
    """host, __prior (log P by language): counts by grouped aggregation, host drawn to domain, domain to all rows.

    Sums by (host, language) happen before the shuffle, so a host with a third of all rows is one row a task.
    Unknown languages and null hosts do not count.
    """
    seen = docs.select(host.alias("host"), declared.alias("declared")).where(F.col("host").isNotNull() & F.col("declared").isin(languages))
    counts = seen.groupBy("host").agg(*[F.sum((F.col("declared") == x).cast("double")).alias(f"n{i}") for i, x in enumerate(languages)]).withColumn("domain", domain_of(F.col("host")))
    total = counts.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0.0)).alias(f"n{i}") for i in range(len(languages))]).first()
    whole = sum(total) + len(languages)
    base = [(n + 1) / whole for n in total]
    domains = counts.groupBy("domain").agg(*[F.sum(f"n{i}").alias(f"d{i}") for i in range(len(languages))])
    d_sum = reduce(lambda a, b: a + b, [F.col(f"d{i}") for i in range(len(languages))])
    n_sum = reduce(lambda a, b: a + b, [F.col(f"n{i}") for i in range(len(languages))])
    joined = counts.join(domains, "domain")
    p_domain = [(F.col(f"d{i}") + STRENGTH * base[i]) / (d_sum + STRENGTH) for i in range(len(languages))]
    p_host = [F.log((F.col(f"n{i}") + STRENGTH * p_domain[i]) / (n_sum + STRENGTH)) for i in range(len(languages))]
    counted = [F.array(*[F.col(f"{c}{i}") for i in range(len(languages))]) for c in "nd"]
    return joined.select("host", F.array(*p_host, F.lit(NO_LANGUAGE)).alias("__prior"), counted[0].alias("__host_counts"), counted[1].alias("__domain_counts"), F.array(*[F.lit(float(n)) for n in total]).alias("__total_counts"))


def prior_of_others(languages: list[str], declared: Column) -> Column:
    """log P by language for a row joined to host_priors(), from the counts without the row's own declaration."""
    own = F.array(*[F.coalesce((declared == x).cast("double"), F.lit(0.0)) for x in languages])
    less = lambda c: F.zip_with(c, own, lambda n, o: n - o)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    drawn = lambda counts, above: F.zip_with(counts, above, lambda n, p: (n + STRENGTH * p) / (total(counts) + STRENGTH))
    every = less("__total_counts")
    base = F.transform(every, lambda n: (n + 1) / (total(every) + len(languages)))
    return F.concat(F.transform(drawn(less("__host_counts"), drawn(less("__domain_counts"), base)), lambda p: F.log(p)), F.array(F.lit(NO_LANGUAGE)))


def fuse(docs: DataFrame, text_col: str = "text", declared_col: str | None = "lang", host_col: str | None = "source", url_col: str | None = None, fit_rows: int = FIT_ROWS, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """docs with __language, __posterior (of that language) and __keep.

    A text is kept if a language is likelier than "und". Texts without letters (null and empty ones too) are "und" and
    not kept. Missing declarations, suffixes and hosts are no evidence. Rows repeat as they come; at a tie the first
    language by name is taken. Other columns may have any names but those three.
    """
    declared = F.lower(F.substring_index(F.col(declared_col).cast("string"), "-", 1)) if declared_col else F.lit(None).cast("string")
    model = fit_trigrams(docs.select(F.col(text_col).alias("text"), declared.alias("lang")), rows=fit_rows)
    languages = model.languages[:-1]
    if not languages:  # nothing declares a language, so nothing is known of any
        return docs.withColumn("__language", F.lit(UNKNOWN)).withColumn("__posterior", F.lit(1.0)).withColumn("__keep", F.lit(False))
    host = F.nullif(F.lower(F.regexp_extract(F.col(url_col).cast("string"), r"^[a-zA-Z]+://(?:[^/@]*@)?([^/:?#]+)", 1)), F.lit("")) if url_col else F.col(host_col).cast("string") if host_col else F.lit(None).cast("string")
    priors = host_priors(docs, languages, host, declared)
    own = unused(docs, "__row")  # all columns as they came, so that no name of theirs meets one of ours
    scored = text_scores(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(own), F.col(text_col).cast("string").alias("__text"), host.alias("__host"), declared.alias("__declared")), model, "__text")
    if priors.limit(broadcast_hosts + 1).count() <= broadcast_hosts:
        priors = F.broadcast(priors)
    joined = scored.join(priors.withColumnRenamed("host", "__host"), "__host", "left").withColumn("__others", prior_of_others(languages, F.col("__declared")))
    suffix = F.element_at(F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair]), F.substring_index(F.col("__host"), ".", -1)) if url_col else F.lit(None).cast("string")

    def given(said: Column, trust: float, x: str) -> Column:
        """log P(what is said | the language is x); said by no known language: no evidence."""
        other = float(np.log((1 - trust) / max(1, len(languages) - 1)))
        return F.when(said.isin(languages), F.when(said == x, F.lit(float(np.log(trust)))).otherwise(F.lit(other))).otherwise(F.lit(0.0))

    logs = F.array(
        *[
            TEMPER * F.col("__scores")[i] + F.coalesce(F.col("__others")[i], F.lit(float(-np.log(len(languages) + 1)))) + (given(F.col("__declared"), TRUST_DECLARED, x) + given(F.col("__suffix"), TRUST_SUFFIX, x) if x != UNKNOWN else F.lit(float(np.log(1 / max(1, len(languages))))))
            for i, x in enumerate(model.languages)
        ]
    )
    joined = joined.withColumn("__suffix", suffix).withColumn("__logs", logs).withColumn("__top", F.array_max("__logs"))
    letters = F.col("__text").rlike(r"\p{L}")
    best = F.when(F.coalesce(letters, F.lit(False)), F.element_at(F.array(*[F.lit(x) for x in model.languages]), F.array_position("__logs", F.col("__top")).cast("int"))).otherwise(F.lit(UNKNOWN))
    share = 1 / F.aggregate("__logs", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top")))
    found = {"__language": best, "__posterior": share, "__keep": best != UNKNOWN}
    return joined.select(*[F.col(f"`{own}`.`{c}`").alias(c) for c in docs.columns if c not in found], *[v.alias(c) for c, v in found.items()])
