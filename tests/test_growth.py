"""Steps whose memory or tasks must not depend on how small Spark reckons its input, and results that follow their SQL."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.jobs import all_queries
from calltrail.jobs.fixtures import Tables
from calltrail.jobs.parser_queries import sources
from calltrail.operators import graph, lookup, ordering, resolution, spans
from calltrail.sources import java

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sources_are_not_gathered_in_the_driver_and_are_spread_over_tasks(spark):
    files = sources(Tables(spark, SF))
    assert "Broadcast" not in plan(files) and "SortMergeJoin" in plan(files)
    assert files.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_worker_scans_some_files_at_a_time():
    text = "class A { void m() { f.go(); } }" + " " * (java.SLICE // 4)
    batch = pa.RecordBatch.from_arrays([pa.array([f"A{k}.java" for k in range(40)]), pa.array([text] * 40)], names=["path", "text"])
    found = list(java.parsed(iter([batch])))
    assert len(found) >= 10 and len({p for b in found for p in b.column(0).to_pylist()}) == 40


def test_what_bodies_and_files_hold_meets_calls_by_sorting(spark):
    n = spark.range(3)
    path = F.concat(F.lit("F"), "id")
    calls = n.select(F.col("id").alias("application"), path.alias("path"), F.lit("C").alias("cls"), F.col("id").alias("body"), F.lit("v").alias("root"), F.lit("m").alias("mth"))
    variables = n.select(F.col("id").alias("body"), F.lit("v").alias("name"), F.lit("Known").alias("type"), F.lit("local").alias("how"))
    fields = n.select(F.lit("C").alias("cls"), F.lit("f").alias("name"))
    index = resolution.import_index(n.select(path.alias("path"), F.lit("com.a.Known").alias("name"), F.lit("type").alias("type")))
    flags = n.select(F.col("id").alias("application"), *[F.lit(False).alias(x) for x in ("include_unqualified", "accept_local_new_types", "accept_parameter_types", "accept_same_package")])
    kept = resolution.keep_calls(calls, variables, fields, index, n.select(path.alias("path"), F.lit("com.a").alias("package")), flags)
    assert plan(kept).count("SortMergeJoin") >= 5
    assert {r.kept_by for r in kept.collect()} == {"imported_type"}


def test_variables_and_ranks_meet_calls_by_sorting(spark):
    rows = spark.createDataFrame([], java.SCHEMA)
    assert plan(resolution.resolved_calls(rows)).count("SortMergeJoin") >= 3
    n = spark.range(3)
    cells = n.select(*[F.concat(F.lit(c), "id").alias(c) for c in ("pcls", "pmth", "cls", "mth")])
    ranks = n.select(*[F.concat(F.lit(c), "id").alias(c) for c in ("cls", "mth", "recv", "callee")], F.col("id").alias("rank"))
    assert plan(lookup.call_rank(cells, ranks)).count("SortMergeJoin") >= 2


def test_lists_are_trimmed_of_blanks_alone_where_asked_for(spark):
    row = spark.createDataFrame([("a, b\t,\n, c ",)], "x string")
    assert row.select(T.split_list(F.col("x"), F.trim), T.split_list(F.col("x"))).first()[:] == (["a", "b\t", "\n", "c"], ["a", "b", "c"])


def test_a_closure_reads_what_was_seen_once_in_some_steps(spark, monkeypatch):
    edges = [(k, k + 1) for k in range(11)] + [(11, 3), (5, 5), (2, 9), (20, 0)]
    follow = {}
    for s, d in edges:
        follow.setdefault(s, set()).add(d)
    want = set()
    for start in (0, 4, 20, 30):
        open_, seen = [start], {start}
        while open_:
            for d in follow.get(open_.pop(), ()):
                if d not in seen:
                    seen.add(d)
                    open_.append(d)
        want |= {(start, s, d) for s, d in edges if s in seen}
    rounds, grown = [], graph._grown
    monkeypatch.setattr(graph, "_grown", lambda *args: rounds.append(args[3]) or grown(*args))
    found = graph.closure(spark.createDataFrame(edges, "src long, dst long"), spark.createDataFrame([(x,) for x in (0, 4, 20, 30)], "start long"))
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert max(rounds) <= 12 // graph.STEPS + 1


def test_lines_and_blocks_meet_tokens_by_sorting(spark):
    files = spark.createDataFrame([("A.java", "class A { void m(int a) { x(); } }")], "path string, text string")
    found = spans.method_lines(files, java.all_tokens(files))
    assert "Broadcast" not in plan(found)
    assert [(r.cls, r.mth, r.block) for r in found.collect()] == [("A", "m", 1)]


def test_chains_meet_variables_and_fields_by_sorting(spark):
    bodies = spark.createDataFrame([("b", "C", "v.go(1).on(2); f.at(x);")], "body string, cls string, source string")
    variables = spark.createDataFrame([("b", "v", "V")], "body string, name string, type string")
    fields = spark.createDataFrame([("C", "f", "Fld")], "cls string, name string, type string")
    found = resolution.chain_calls(bodies, variables, fields, spark.createDataFrame([], "body string, mth string"))
    assert "BroadcastHashJoin" not in plan(found)
    assert {r.call for r in found.where("how = 'rewritten'").collect()} == {"V.go(1).on(2)", "Fld.at(x)"}


@pytest.mark.parametrize("name", ["brace_match", "lineage_rows", "method_inventory", "call_rank", "calls_fallback", "calls_chain"])
def test_rows_of_files_are_not_gathered_in_the_driver(spark, name):
    assert "BroadcastHashJoin" not in plan(all_queries()[0][name](spark, SF))


def test_rows_that_nobody_asks_for_stay_in_their_worker(spark):
    good, bad = "class A { int f; void m() { f.go(); } }", "class B { void m( { } }"
    batch = pa.RecordBatch.from_arrays([pa.array(["A.java", "B.java"]), pa.array([good, bad])], names=["path", "text"])
    found = [r for b in java.parsed(iter([batch]), kinds=("type",)) for r in b.to_pylist()]
    assert [(r["cls"], r["kind"], r["fallback"]) for r in found] == [("A", "type", False), ("B", "type", True)]
    files = spark.createDataFrame([("A.java", good + "// {"), ("C.java", "'{' \"}\"")], "path string, text string")
    assert [(r.text, r.pos) for r in java.all_tokens(files, marks="{}").orderBy("pos").collect()] == [(x, k) for k, x in enumerate(good) if x in "{}"]


def test_tokens_and_their_lines_are_those_of_the_pattern():
    text = "a1 é٣x\n\n /* b\nc */ \"x\\\ny\" 'q' \"open\n// t\n  $d.e(1.5f) \x0b\x1c' ''\n  /* end\n \n"
    want = [(m.lastgroup, m[0], m.start(), 1 + text.count("\n", 0, m.start())) for m in java._TOKEN.finditer(text)]
    assert list(java.pieces(text)) == want and len(want) > 15
    assert list(java.pieces("x" + " " * 1_000_000)) == [("word", "x", 0, 1)] and list(java.pieces("")) == []


def test_bodies_are_found_in_one_pass_over_tokens_spread_over_tasks(spark, monkeypatch):
    tokens = java.scan_tokens(spark.createDataFrame([("src/A.java", "class A { int f; void m() { b.go(); { b.go(); on(); } } } }"), ("src/B.java", "class B { void n() { on(); } }")], "path string, text string"))
    scoped = plan(spans.with_scope(tokens))
    assert scoped.count("MapInArrow") == 1 and "REPARTITION_BY_NUM" in scoped
    asked, rank = [], ordering.global_rank
    monkeypatch.setattr(ordering, "global_rank", lambda df, *args: asked.append(df) or rank(df, *args))
    found = spans.call_order(tokens)
    assert len(asked) == 1 and "Window" not in plan(asked[0]) and "MapInArrow" not in plan(asked[0])
    assert sorted((r.rank, r.cls, r.mth, r.recv, r.callee) for r in found.collect()) == [(0, "a", "m", "b", "go"), (1, "a", "m", None, "on"), (2, "b", "n", None, "on")]
