"""Numbered queries against their SQL on the supplied tables, and stages on tables with odd columns and rows."""

import duckdb
import pytest
from test_numbered import multiset, sentence, similarity

import corpus_pipeline
from calltrail.llm import neardup
from calltrail.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ODD = ["__digest", "__id", "__n", "__clean", "__host", "__prior", "__row", "__spans", "__payload", "__first", "__text", "__language", "digest", "id", "text_id"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, want = QUERIES[name](spark, SF), con.sql(ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, (tuple(r[want.columns.index(c)] for c in columns) for r in want.fetchall())))


def test_all_near_pairs_of_the_supplied_table_share_a_class(spark):
    """Recall against comparing all pairs, and no class beyond what such pairs join."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    sets = {d: multiset(t) for d, t in rows}
    by_shingle = {}
    for d, s in sets.items():
        for g in s:
            by_shingle.setdefault(g, []).append(d)
    pairs = {(a, b) for own in by_shingle.values() for i, a in enumerate(own) for b in own[i + 1 :]}
    near = [(a, b) for a, b in pairs if similarity(sets[a], sets[b]) >= 0.8]
    got = {r.id: r.group_id for r in neardup.groups(spark, docs).collect()}
    assert len(near) > 50 and sum(got[a] == got[b] for a, b in near) >= 0.999 * len(near)
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in near:
        root[max(find(a), find(b))] = min(find(a), find(b))
    texts = {}
    for d, t in rows:
        a, b = find(d), find(texts.setdefault(t, d))
        root[max(a, b)] = min(a, b)
    assert sum(got[d] != find(d) for d, _ in rows) <= 0.001 * len(rows)


def test_stages_take_odd_columns_and_rows(spark, tmp_path):
    import random

    r = random.Random(3)
    kinds = ", ".join(f"`{c}` STRING" for c in ODD)
    texts = [sentence(r, 40), sentence(r, 40), None, "", "x", sentence(r, 2500), sentence(r, 30) + " a@b.org", "\ud800 odd".encode("utf-8", "replace").decode()]
    rows = [(k, t, "en" if k % 2 else None, None if k % 3 else "s", None, *[None if k % 2 else "v"] * len(ODD)) for k, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, texts[1], None, None, None, *["w"] * len(ODD)), (None, None, None, None, None, *[None] * len(ODD))]
    docs = spark.createDataFrame(rows, f"doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, {kinds}")
    spark.createDataFrame([(None, sentence(r, 12)), (1, None), (2, "")], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, str(tmp_path))
            found = out.collect()
            assert name == "token_ids" or out.columns == docs.columns
            assert (len(found) == 0) == (table is not docs)
        if name == "personal_data":
            assert sum(x.text is None for x in stage(spark, docs, str(tmp_path)).collect()) == 2 and len(stage(spark, docs, str(tmp_path)).collect()) == len(rows)
