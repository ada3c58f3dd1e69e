"""Operators on small rows: nulls, ties, cycles, and laws that hold for any input."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.operators import graph, lookup, ordering, resolution
from calltrail.sources import files as S
from calltrail.sources import adapters, settings as conf
from calltrail.sources.java import COLUMNS, SCHEMA, Scanner, blanked, code_tokens


def calls(spark, text, **options):
    """Calls of one file: sites of the scanner, typed by joins."""
    rows = spark.createDataFrame([(*[r.get(c) for c in COLUMNS],) for r in Scanner("A.java", text).run()], SCHEMA)
    return {(r["mth"], r["name"], r["type"]) for r in resolution.resolved_calls(rows, **options).collect()}


@pytest.mark.parametrize(
    ("body", "want"),
    [
        ("m2();", {("A.m2()", "sibling")}),
        ("this.m2();", {("A.m2()", "sibling")}),
        ("f.go();", {("Foo.go()", "qualified")}),
        ("this.f.go();", {("Foo.go()", "this_field")}),
        ("f.a().b();", {("Foo.a()", "qualified"), ("Foo.a().b()", "chain")}),
        ("new X(f.go());", {("X.X()", "ctor"), ("Foo.go()", "qualified")}),
        ("throw new E();", {("E.E()", "throw")}),
        ("String s = \"g();\"; // h();", set()),
        ("if (f.ok()) { }", {("Foo.ok()", "qualified")}),
        ("Bar b = new Baz(); b.go();", {("Baz.Baz()", "ctor"), ("Baz.go()", "qualified")}),
        ("make(1).then();", {("A.make()", "sibling"), ("then()", "dynamic")}),
        ("char c = '{'; f.go();", {("Foo.go()", "qualified")}),
        ("new B().go().stop();", {("B.B()", "ctor"), ("B.go()", "qualified"), ("B.go().stop()", "chain")}),
        ("((B) c).go().then();", {("B.go()", "qualified"), ("B.go().then()", "chain")}),
        ("g.h.go();", {("g.h.go()", "qualified")}),
        ("f.x.a().b();", {("Foo.x.a()", "qualified"), ("Foo.x.a().b()", "chain")}),
        ("this.m2().f.b();", {("A.m2()", "sibling"), ("A.m2().f.b()", "chain")}),
        ("this.f.a().b();", {("Foo.a()", "this_field"), ("Foo.a().b()", "chain")}),
        ("Foo[] l = null; l[0].go();", {("Foo.go()", "qualified")}),
        ("List<Foo> f = x; f.get(0);", {("List.get()", "qualified")}),
        ("new T() { void r() { f.go(); m9(); } };", {("T.T()", "ctor"), ("Foo.go()", "qualified"), ("A$1.m9()", "sibling")}),
    ],
)
def test_call_forms(spark, body, want):
    assert {(n, k) for _, n, k in calls(spark, f"class A {{ Foo f; void m() {{ {body} }} }}")} == want


def test_bare_calls_only_where_asked_for(spark):
    assert calls(spark, "class A { void m() { m2(); this.m3(); make().then(); } }", include_unqualified=False) == {("m", "A.m3()", "sibling"), ("m", "then()", "dynamic")}


def test_overloads_have_variables_of_their_own(spark):
    assert {n for _, n, _ in calls(spark, "class A { B x; void m(C x) { x.go(); } void m(D x) { x.go(); } void m() { x.go(); } }")} == {"C.go()", "D.go()", "B.go()"}


def test_fields_behind_methods_nested_types_and_generics(spark):
    rows = Scanner("A.java", "class A<T extends B<C>> { <R> List<R> m(Map<String, R> x) { f.go(); return null; } class I { int n() { return 1; } } Foo f; }").run()
    methods = {(r["cls"], r["mth"], r["type"], r["extra"]) for r in rows if r["kind"] == "method"}
    assert methods == {("A", "m", "List<R>", "Map<String,R>"), ("I", "n", "int", "")}
    assert ("m", "f.go()", "plain") in {(r["mth"], r["name"], r["type"]) for r in rows if r["kind"] == "site"}
    assert ("m", "Foo.go()", "qualified") in calls(spark, "class A { <R> void m(R x) { f.go(); } class I { } Foo f; }")


def test_unmatched_brackets_give_an_error_row_and_a_second_scan():
    rows = Scanner("A.java", "class A { B x; void m() { x.go(); }").run()
    assert [r["kind"] for r in rows] == ["error", "type", "field", "method", "site"] and all(r["fallback"] for r in rows)
    assert rows[-1]["name"] == "x.go()" and Scanner("E.java", "").run() == []


@pytest.mark.parametrize("text", ["import a.b", "class A", "class A { void m() }", "package x", "enum E", "class A { int f(", "@", "class A { void m() { new X( } }", "class A<T { void m() { a[; } }"])
def test_a_broken_file_is_an_error_row(text):
    rows = Scanner("A.java", text).run()
    assert all(set(r) <= set(COLUMNS) for r in rows) and (text == "@" or rows[0]["kind"] == "error")
    code_tokens(text)


@settings(max_examples=300, deadline=None)
@given(st.data())
def test_no_text_stops_the_scanner(data):
    whole = "package a; import b.C; @X(1) class A<T> extends B { int a = 1, b; enum E { P(1), Q { } } void m(int x) throws Y { C c = new C() { void in() { z.y(); } }; ((D) c).go(); a[0].k().l(); for (F f : g) { } } }"
    cut = data.draw(st.integers(0, len(whole)))
    drop = data.draw(st.sets(st.integers(0, len(whole) - 1), max_size=6))
    text = "".join(c for k, c in enumerate(whole[:cut]) if k not in drop) + data.draw(st.text("(){}[]<>;,.@\"' abnewclass", max_size=12))
    Scanner("A.java", text).run()
    code_tokens(text)


def test_shared_declarations_casts_indexes_and_inner_classes(spark):
    text = "class A { int a = 1, b = 2; Map<String, B> c, d; B[] arr; void m() { int p = f(1, 2), q; B r, s = new C(); ((B) c).go(); arr[0].k(); r.x(new R() { void in() { z.y(); } }); foo(a, b); } }"
    rows = Scanner("A.java", text).run()
    assert {r["name"] for r in rows if r["kind"] == "field"} == {"a", "b", "c", "d", "arr"}
    assert {(r["name"], r["type"]) for r in rows if r["kind"] == "var"} == {("p", "int"), ("q", "int"), ("r", "B"), ("s", "B")}
    assert {n for _, n, _ in calls(spark, text)} == {"A.f()", "C.C()", "B.go()", "B.k()", "B.x()", "R.R()", "A.foo()", "z.y()"}


def test_patterns_find_what_no_scan_does():
    scanner = Scanner("A.java", "class A { Foo f = x; void m() { throw new E(); a.b.c(); new D(); }")
    scanner.fallback = True
    scanner._patterns()
    assert {(r["kind"], r.get("mth"), r.get("name")) for r in scanner.rows} == {("type", None, None), ("var", None, "f"), ("method", "m", None), ("call", "m", "E.E()"), ("call", "m", "a.b.c()"), ("call", "m", "D.D()")}


def test_blanked_keeps_code():
    assert blanked('a /* b */ "c" d // e\nf') == "a   d \nf"
    assert blanked('a /* b */ "c"', literals=False) == 'a  "c"'


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.from_regex(r"[a-z]{1,6}", fullmatch=True), st.integers(0, 999)), min_size=1, max_size=8))
def test_token_parse_undoes_format(spark, tokens):
    df = spark.createDataFrame(tokens, "name STRING, loc BIGINT").select("name", "loc", T.parse_token(T.format_token(F.col("name"), F.col("loc"))).alias("t"))
    assert all(r.t.kind == "method" and (r.t.name, r.t.loc) == (r.name, r["loc"]) for r in df.collect())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=12))
def test_paths_are_simple_and_reach_only_reachable_nodes(spark, edges):
    e = spark.createDataFrame([*edges, (0, 1)], "src BIGINT, dst BIGINT")
    roots = spark.createDataFrame([(0,)], "node BIGINT")
    paths = [r.path for r in graph.simple_paths(e, roots).collect()]
    assert all(len(set(p[:-1])) == len(p) - 1 and p[0] == 0 for p in paths)
    seen = {r.node for r in graph.reachable(e, roots).collect()}
    assert {n for p in paths for n in p} == seen


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9)), max_size=10), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9)), max_size=10, unique=True))
def test_as_of_joins(spark, left, right):
    lf = spark.createDataFrame(left, "k INT, p INT")
    rf = spark.createDataFrame([(k, p, p) for k, p in right], "k INT, q INT, v INT")
    back = sorted((r.k, r.p, r.found if r.found is not None else -1) for r in lookup.as_of_backward(lf, rf, "k", "p", "q", "v").collect())
    assert back == sorted((k, p, max((q for j, q in right if j == k and q <= p), default=-1)) for k, p in left)
    ahead = sorted((r.k, r.p, r.found if r.found is not None else -1) for r in lookup.as_of_forward(lf, rf, "k", "p", "q", "v").collect())
    assert ahead == sorted((k, p, min((q for j, q in right if j == k and q >= p), default=-1)) for k, p in left)


def test_global_rank_is_a_permutation_in_order(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 37) % 101)
    got = ordering.global_rank(df, ["v", "id"], "pos").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1000)) and [(r.v, r.id) for r in got] == sorted((i * 37 % 101, i) for i in range(1000))


def test_global_rank_over_many_ranges(spark):
    """More rows than the range sampler keeps, in skewed order, with a payload that only one reader needs."""
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(2_000_000, numPartitions=16).select((F.pmod(F.xxhash64("id"), F.lit(1000)) * F.pmod(F.xxhash64("id"), F.lit(7))).alias("v"), "id", F.concat(F.lit("payload"), F.col("id").cast("string")).alias("__range"))
        got = ordering.global_rank(df, ["v", "id"], "pos")
        n = got.agg(F.countDistinct("pos"), F.min("pos"), F.max("pos")).first()
        assert tuple(n) == (2_000_000, 0, 1_999_999) and got.columns == ["v", "id", "__range", "pos"]
        ends = got.agg(F.min_by("id", "pos"), F.min_by("id", F.struct("v", "id")), F.max_by("id", "pos"), F.max_by("id", F.struct("v", "id"))).first()
        assert ends[0] == ends[1] and ends[2] == ends[3]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_runs_and_ranks_over_blocks(spark):
    values = [None, None, "a", "a", "b", "a", "a", "a", None, "b", "b"] * 3
    df = spark.createDataFrame(list(enumerate(values)), "id INT, v STRING")
    want, at = [], 0
    for k in range(1, len(values) + 1):
        if k == len(values) or values[k] != values[at]:
            want.append((values[at], at, k - 1, k - at))
            at = k
    for size in (4, 5, 1 << 16):
        got = sorted(tuple(r) for r in ordering.global_runs(df, "v", ["id"], size=size).select("first", "v", "last", "n").collect())
        assert [(v, f, x, n) for f, v, x, n in got] == want
    ranks = ordering.rank_within(df.where("v IS NOT NULL"), ["v"], ["id"], "r").collect()
    assert {(r.v, r.r): r.id for r in ranks} == {(v, k): i for v in "ab" for k, i in enumerate(j for j, x in enumerate(values) if x == v)}


def test_settings_and_adapters(spark):
    config = conf.Config({"PRIMITIVE": ["int"]}, {"a": "x&lt;(?P<k>y)(?P=k)", "bad": "(", "none": 3})
    assert config.pattern("a") == r"x<(?<k>y)\k<k>" and config.words("PRIMITIVE") == ("int",) and "List" in config.words("COLLECTION_TYPES")
    for name in ("none", "missing"):
        with pytest.raises(KeyError):
            config.pattern(name)
    with pytest.raises(KeyError):
        config.words("missing")
    df = spark.createDataFrame([("a", "class A { void m() { x.y(); } }", "java"), ("b", "<p>go(1)", "script"), ("c", "x", "cobol"), ("d", None, "java")], "path STRING, text STRING, language STRING")
    got = adapters.parse(df, "language").collect()
    assert {(r.path, r.kind, r.name) for r in got if r.kind in ("call", "site", "error")} == {("a", "site", "x.y()"), ("b", "call", "go()"), ("c", "error", "no adapter for cobol")}


def test_overloads_go_by_arity_then_types_then_lines(spark):
    methods = spark.createDataFrame([("A", "m", ["int"], 1), ("A", "m", ["int", "String"], 2), ("A", "m", ["String", "long"], 3), ("B", "m", None, 9)], "cls STRING, mth STRING, types ARRAY<STRING>, loc INT")
    want = spark.createDataFrame([(1, "A", "m", ["int", "java.lang.String"]), (2, "A", "m", ["x", "y"]), (3, "A", "m", ["a", "b", "c"]), (4, "B", "m", None), (5, "C", "m", [])], "k INT, cls STRING, mth STRING, want ARRAY<STRING>")
    assert {r.k: r["loc"] for r in lookup.best_overload(want, methods).collect()} == {1: 2, 2: 3, 3: 3, 4: 9}


def test_bare_names_are_expanded_before_paths(spark):
    calls_ = spark.createDataFrame([("A.m", "go()"), ("A.m", "B.x"), ("B.x", "lost"), ("C.go", "")], "caller STRING, callee STRING")
    methods = spark.createDataFrame([("C", "go", "class", "public", ""), ("D", "go", "interface", "default", ""), ("E", "go", "class", "private", "")], "cls STRING, mth STRING, type STRING, access STRING, annotations STRING")
    got = {(r.src, r.dst) for r in graph.resolved_edges(calls_, methods).collect()}
    assert got == {("a.m", "c.go"), ("a.m", "d.go"), ("a.m", "b.x"), ("b.x", "b.lost")}


def test_pruned_root_has_no_path_and_cycles_end(spark):
    e = spark.createDataFrame([(0, 1), (1, 0), (1, 2), (2, 2)], "src INT, dst INT")
    roots = spark.createDataFrame([(0,)], "node INT")
    assert sorted(r.path for r in graph.simple_paths(e, roots).collect()) == [[0, 1, 0], [0, 1, 2, 2]]
    assert graph.simple_paths(e, roots, roots).count() == 0


def test_nulls_and_sentinels(spark):
    df = spark.createDataFrame([(None,), ("",), ("None",), ("null",), ("na",), ("a.b()",)], "c STRING")
    assert [r.c for r in df.where(~T.is_sentinel(F.col("c"))).collect()] == ["a.b()"]
    assert df.where(~T.is_system_call(F.col("c"))).count() == 6
    assert df.select(T.split_list(F.col("c")).alias("x")).collect()[0].x == []


def test_inheritance_cycle(spark):
    returns = spark.createDataFrame([("C", "m", "int", 1)], "cls STRING, method STRING, ret STRING, pos BIGINT")
    parents = spark.createDataFrame([("A", "B"), ("B", "A"), ("D", "C")], "cls STRING, parent STRING")
    rows = spark.createDataFrame([("A", "m"), ("D", "m"), ("D", "x")], "c STRING, f STRING")
    got = {(r.c, r.f): r.owner for r in lookup.inherited_owner(rows, "c", "f", returns, parents).collect()}
    assert got == {("A", "m"): "A", ("D", "m"): "C", ("D", "x"): "D"}


def test_properties_and_missing_columns(spark):
    lines = spark.createDataFrame([("a", 1, "# c"), ("a", 2, "k=v=w"), ("b", 1, "k: x"), ("b", 2, "!n"), ("b", 3, " ")], "path STRING, line_no INT, line STRING")
    assert {r.key: r.value for r in S.properties(lines).collect()} == {"k": "x"}
    with pytest.raises(ValueError, match="missing columns: z"):
        S.require_columns(lines, ["path", "z"])


def test_plans_push_filters_and_columns_down(spark):
    from calltrail.jobs import all_queries

    plan = all_queries()[0]["sheet_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "GreaterThan(p_size,25)" in plan and "p_retailprice" not in plan.split("== Physical Plan ==")[1]
