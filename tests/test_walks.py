"""Graph walks, matching, spans and resolution against plain versions on small inputs."""

import random
import re
from collections import deque

import pytest

from calltrail.operators import graph, matching, resolution, spans
from calltrail.sources import files as S
from calltrail.sources import java


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- walks ------------------------------------------------------------------------------------------------------------


def test_discovery_is_a_queue(spark):
    r = random.Random(1)
    for _ in range(3):
        edges = [(a, b, k) for a in range(40) for k, b in enumerate(r.sample(range(60), r.randint(0, 4)))]
        seeds = [(5, 0), (0, 1), (7, 2), (5, 3)]
        by, seen, order, queue = {}, set(), [], deque()
        for a, b, _k in edges:
            by.setdefault(a, []).append(b)

        def enqueue(node, depth, seen=seen, order=order, queue=queue):
            if node not in seen:
                seen.add(node)
                order.append((node, depth, len(order)))
                queue.append((node, depth))

        for node, _ in sorted(seeds, key=lambda x: x[1]):
            enqueue(node, 0)
        while queue:
            node, depth = queue.popleft()
            for b in by.get(node, []):
                enqueue(b, depth + 1)
        got = graph.discovery(spark.createDataFrame(edges, "src INT, dst INT, place INT"), spark.createDataFrame(seeds, "node INT, place INT"))
        assert rows(got) == sorted(order, key=repr)


def test_long_walks_are_put_together_again(spark, monkeypatch):
    monkeypatch.setattr(graph, "COMPACT", 3)
    edges = spark.createDataFrame([(k, k + 1, 0) for k in range(11)] + [(11, 0, 0)], "src INT, dst INT, place INT")
    seeds = spark.createDataFrame([(0, 0)], "node INT, place INT")
    assert rows(graph.reachable(edges, seeds)) == sorted([(k, k) for k in range(12)], key=repr)
    assert rows(graph.discovery(edges, seeds)) == sorted([(k, k, k) for k in range(12)], key=repr)
    assert graph.closure(edges, spark.createDataFrame([(5,)], "start INT")).count() == 12


def test_closure_by_name_is_a_walk(spark):
    methods = [("A", "go", "a", 1), ("B", "go", "b", 2), ("B", "run", "b", 2), ("C", "leaf", "c", 3), ("A", "self", "a", 1), ("D", "ping", "d", 4), ("D", "pong", "d", 4)]
    calls = [("A", "go", "X.run(a.b)"), ("A", "go", "leaf()"), ("B", "go", "never()"), ("B", "run", "Z.go()"), ("B", "run", "ext.gone(1)"), ("A", "self", "A.self()"), ("D", "ping", "pong()"), ("D", "pong", "D.ping()"), ("D", "pong", "ping()"), ("C", "leaf", "")]
    starts = ["Q.go", "go()", "run", "nobody()", "A.self()", "ping", "D.pong()"]
    owner, listed = {}, {}
    for cls, mth, file, _ in sorted(methods, key=lambda m: m[3]):
        owner.setdefault(mth, (cls, file))
    for cls, mth, call in calls:
        listed.setdefault((cls, mth), []).append(call)
    want = set()

    def walk(start, current, visited):
        name = current.split("(")[0].split(".")[-1]
        if name not in owner:
            want.add((start, "Unknown", current, ""))
            return
        cls, file = owner[name]
        found = [c for c in listed.get((cls, name), []) if c]
        if not found:
            want.add((start, file, current, ""))
        for c in found:
            want.add((start, file, current, c))
            if c not in visited:
                visited.add(c)
                walk(start, c, visited)

    for s in starts:
        walk(s, s, {s})
    got = graph.closure_by_name(spark.createDataFrame(methods, "cls STRING, mth STRING, file STRING, at INT"), spark.createDataFrame(calls, "cls STRING, mth STRING, call STRING"), spark.createDataFrame([(s,) for s in starts], "start STRING"))
    assert rows(got) == sorted(want, key=repr)


def test_flow_edges_redirect_prune_and_label(spark):
    methods = spark.createDataFrame([(c, m, "class", "public", "") for c, m in (("A", "a"), ("Svc", "b"), ("SvcImpl", "b"), ("Dvt", "x"), ("E", "e"))], "cls STRING, mth STRING, type STRING, access STRING, annotations STRING")
    calls = spark.createDataFrame([("A.a", "Svc.b(q.r)"), ("A.a", "Dvt.x()"), ("A.a", "Lib.z()"), ("SvcImpl.b", "e()"), ("Dvt.x", "E.e"), ("E.e", "lost()")], "caller STRING, callee STRING")
    lines = spark.createDataFrame([("A", "a", 3), ("svcimpl", "B", 7), ("Lib", "z", 2)], "cls STRING, mth STRING, loc INT")
    edges, labels = graph.flow_edges(calls, methods, lines, spark.createDataFrame([("dvt",)], "cls STRING"))
    n = " no_of_lines : "
    assert rows(edges) == sorted([(f"A.a{n}3", f"SvcImpl.b{n}7"), (f"A.a{n}3", f"Lib.z{n}2"), (f"SvcImpl.b{n}7", f"E.e{n}0"), (f"E.e{n}0", f"e.lost{n}0")], key=repr)
    assert ("svc.b", f"Svc.b{n}0") in rows(labels)


@pytest.mark.parametrize("most", [1, 5, 1 << 20])
def test_matching_finds_every_part(spark, most):
    r = random.Random(3)
    stems = ["a", "ab", "abc", "b", "cab", "", None, "zz", "日本", "."]
    cells = ["".join(r.choice("abcz.日本") for _ in range(r.randint(0, 12))) for _ in range(60)] + [None, ""]
    got = matching.contained(spark.createDataFrame([(c,) for c in cells], "cell STRING"), spark.createDataFrame([(s,) for s in stems], "stem STRING"), most)
    assert rows(got) == sorted([(c, s) for c in cells if c for s in stems if s and s in c], key=repr)
    assert matching.contained(spark.createDataFrame([("x",)], "cell STRING"), spark.createDataFrame([], "stem STRING")).collect() == []


# --- spans ------------------------------------------------------------------------------------------------------------

NESTED = """class A {
    void go(int a) { x.run(); x.run(); helper(); new Thread(new Runnable() {
        public void run() { helper(); y.stop(); helper(); }
    }).start(); helper(); x.run(); }
    void go(String s) { x.run(); Go(); }
    int f = init();
    void Late() { }
    { helper(); }
}
"""


def test_calls_belong_to_the_innermost_open_body(spark):
    files = [("b/A.java", NESTED), ("A.java", "class A { void go() { z.z(); } }"), ("b/c/D.java", "class D { void go() { a(); } }"), ("b2/E.java", "class E { void e() { a(); A(); } }"), ("x.java", None)]
    want, n = [], 0
    for path, text in sorted([f for f in files if f[1]], key=lambda f: (f[0].split("/")[:-1], f[0].split("/")[-1])):
        stack, depth = [], 0
        for t in java.code_tokens(text):
            if t["kind"] == "open":
                depth += 1
            elif t["kind"] == "close":
                depth -= 1
                while stack and depth < stack[-1][1]:
                    stack.pop()
            elif t["kind"] == "decl":
                stack.append((t["name"].lower(), depth + 1, set()))
            elif stack:
                key = (t.get("recv") and t["recv"].lower(), t["name"].lower())
                if key not in stack[-1][2]:
                    stack[-1][2].add(key)
                    want.append((path.split("/")[-1][:-5].lower(), stack[-1][0], *key, n))
                    n += 1
    got = spans.call_order(java.scan_tokens(spark.createDataFrame(files, "path STRING, text STRING")))
    assert rows(got.select("cls", "mth", "recv", "callee", "rank")) == sorted(want, key=repr)
    assert got.where("mth = 'go' AND path = 'b/A.java'").select("opened").distinct().count() == 2


LINES = """package p;
@A({1, 2})
public class T<X extends Y<Z>> {
    @B(x = "{", y = {"a",

        "b"})
    @C
    public static <R> Map<String, List<R>> two(final Map<String, R> m, int... n)
            throws E {
        if (a) { b(); } // }

        return c > two(1);
    }
    @D

    void two(String s) { }
    // @E
    T(int a) { }
    int field = two(1);
    abstract void none(@Q("(") String s,
        int b);
    interface I {
        void none(int a);
        default int two(long[] z) { return () -> two(2); }
    }
    void open() {
"""


def test_lines_by_four_rules(spark):
    files = spark.createDataFrame([("T.java", LINES)], "path STRING, text STRING")
    got = {(r.cls, r.mth, ";".join(r.types)): (r.block, r.block_filled, r.opened_filled, r.file_first) for r in spans.method_lines(files, java.all_tokens(files)).collect()}
    want = {
        ("T", "two", "Map;int[]"): (10, 8, 8, 10),
        ("T", "two", "String"): (1, 1, 1, 10),
        ("T", "T", "int"): (1, 1, 1, 1),
        ("T", "none", "String;int"): (2, 2, 6, 6),
        ("T", "none", "int"): (1, 1, 2, 6),
        ("T", "two", "long[]"): (1, 1, 1, 10),
        ("T", "open", ""): (2, 1, 1, 2),
    }
    want |= {("I", m, t): v for (c, m, t), v in want.items() if (m, t) in (("none", "int"), ("two", "long[]"))}
    assert got == want


def test_brackets_of_one_kind_do_not_disturb_another(spark):
    files = spark.createDataFrame([("a", "{ ( [ ] } ) { ] }")], "path STRING, text STRING")
    found = spans.with_partners(java.all_tokens(files).where("kind = 'mark'"))
    assert {(r.text, r.pos): r.closes for r in found.collect()} == {("{", 0): 8, ("(", 2): 10, ("[", 4): 6, ("{", 12): 16}


# --- resolution -------------------------------------------------------------------------------------------------------


def test_chains_claim_names_in_their_own_body_only(spark):
    bodies = [("x", "C", "new B().go().stop(); f(x).shut(); b.go();"), ("y", "C", "a.b().stop(); g(1).shut(); B.of(2).end();"), ("z", "C", None), ("w", "D", "fld.x(1).y(2); return.x(1); "), ("v", "C", "fld.x(1).y(2);")]
    variables = [("x", "b", "Big<T>"), ("v", "fld", "Local")]
    fields = [("D", "fld", "Member<T>[]")]
    qualified = [("y", "end"), ("w", "y"), ("v", "y")]
    got = resolution.chain_calls(*[spark.createDataFrame(x, s) for x, s in ((bodies, "body STRING, cls STRING, source STRING"), (variables, "body STRING, name STRING, type STRING"), (fields, "cls STRING, name STRING, type STRING"), (qualified, "body STRING, mth STRING"))])
    assert rows(got) == sorted(
        [("x", "B.go()", "ctor"), ("x", "B.stop()", "ctor"), ("x", "f.shut()", "ctor"), ("x", "Big.go()", "rewritten"), ("y", "g.shut()", "ctor"), ("y", "B.of(2).end()", "class"), ("y", "stop()", "dynamic"), ("w", "Member.x(1).y(2)", "rewritten"), ("v", "Local.x(1).y(2)", "rewritten")],
        key=repr,
    )


def test_fold_of_field_chains(spark):
    types = spark.createDataFrame([("F.java", "Repo", "Store<X>", 1), ("G.java", "dao", "Dao", 2), ("F.java", "dao", "List<Y>", 1), ("F.java", "dao", "FileDao", 3)], "file_name STRING, var STRING, type STRING, pos INT")
    returns = spark.createDataFrame([("Store", "open", "com.x.Door<Q>", 1), ("Door", "lock", "void", 1), ("Own", "mine", "Mine", 1), ("FileDao", "first", "Row", 1), ("FileDao", "first", "LastRow", 2)], "cls STRING, method STRING, ret STRING, pos INT")
    chains = spark.createDataFrame(
        [(1, "F.java", "Own", "repo.open.go"), (2, "F.java", "Own", "repo.open.lock.go"), (3, "F.java", "Own", "go"), (4, "F.java", "Own", "this.mine.go"), (5, "H.java", "Own", "x.DAO.first.go"), (6, "F.java", "Own", " repo . dao . first . unknown . go"), (7, "H.java", "Own", "unknown.thing.go")],
        "id INT, file_name STRING, class_interface_name STRING, path STRING",
    )
    want = [(1, "Door", "go"), (2, "Door", "go"), (3, "Own", "go"), (4, "Mine", "go"), (5, "LastRow", "go"), (6, "LastRow", "go"), (7, "unknown", "go")]
    got = resolution.fold_chains(chains, types, spark.createDataFrame([("Nothing",)], "cls STRING"), returns)
    anywhere = {r.id: r.cls for r in got.collect()}
    assert anywhere[5] in ("LastRow", "Dao") and rows(got.where("id <> 5")) == [w for w in want if w[0] != 5]


# --- files ------------------------------------------------------------------------------------------------------------


def test_properties_with_carriage_returns_and_tabs(spark):
    text = "\tk1=v1\r\nk2 = v2\r\n\t# c=1\r\n\r\n ! d=2\r\nk3\t:\ta=b\r\nk4:c:d\r\n=x\r\n"
    lines = spark.createDataFrame([("p", k, line) for k, line in enumerate(text.split("\n"))], "path STRING, line_no INT, line STRING")
    assert rows(S.properties(lines)) == [("", "x"), ("k1", "v1"), ("k2", "v2"), ("k3\t:\ta", "b"), ("k4", "c:d")]


def test_lossy_decoding_keeps_real_marks(spark):
    r = random.Random(4)
    raws = [bytes(r.choice([0x41, 0xC3, 0xA9, 0xEF, 0xBF, 0xBD, 0xE2, 0x82, 0xAC, 0xFF, 0xF0]) for _ in range(r.randint(0, 9))) for _ in range(400)] + ["a\ufffdb\ufdd0é".encode()]
    df = spark.createDataFrame([(bytearray(x),) for x in raws], "raw BINARY")
    assert [x[0] for x in df.select(S.decode_lossy(df.raw)).collect()] == [x.decode("utf-8", "ignore") for x in raws]


@pytest.mark.parametrize("root", ["build/x", "plain", "a/out/bin"])
def test_pruning_looks_below_the_root_only(spark, tmp_path, root):
    for at in ("A.java", "in/B.java", "build/C.java", "in/target/D.java", "builder/E.java", ".git/F.java"):
        f = tmp_path / root / at
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text("x")
    found = {r.file_name for r in S.scan_files(spark, str(tmp_path / root), pruned=True).collect()}
    assert found == {"A.java", "B.java", "E.java"} and S.scan_files(spark, f"file://{tmp_path}/{root}/", pruned=True).count() == 3


def test_a_failed_write_leaves_the_old_book(spark, tmp_path):
    book, one, two = str(tmp_path / "book"), spark.range(3), spark.range(5)
    S.write_sheets(book, {"A": one, "B": one})
    with pytest.raises(Exception, match="broken"):
        S.write_sheets(book, {"A": two, "B": two.selectExpr("raise_error('broken') AS id")})
    assert S.read_sheet(spark, book, "A").count() == 3 and S.read_sheet(spark, book, "B").count() == 3
    assert S.write_sheets(book, {"B": two, "C": two}, "append") == {"B": "B1", "C": "C"}
    S.write_sheets(book, {"A": two}, "update")
    assert {k: S.read_sheet(spark, book, k).count() for k in S.sheets_of(spark, book)[1]} == {"A": 5, "B": 3, "B1": 5, "C": 5}
    S.write_sheets(book, {"Z": one})
    S.drop_old_sheets(spark, book)
    assert list(S.sheets_of(spark, book)[1]) == ["Z"] and S.read_sheet(spark, book, "Z").count() == 3
    with pytest.raises(FileNotFoundError):
        S.read_sheet(spark, book, "A")
    assert len([p for p in (tmp_path / "book").iterdir() if re.match(r"[A-Z]", p.name)]) == 1


def test_of_two_writers_at_once_one_fails(spark, tmp_path, monkeypatch):
    book = str(tmp_path / "book")
    S.write_sheets(book, {"A": spark.range(1)})
    stale = S.sheets_of(spark, book)
    S.write_sheets(book, {"A": spark.range(2)})
    monkeypatch.setattr(S, "sheets_of", lambda *_: stale)
    with pytest.raises(Exception, match="(?i)exist"):
        S.write_sheets(book, {"A": spark.range(7)})
    monkeypatch.undo()
    assert S.read_sheet(spark, book, "A").count() == 2


def test_projects_keep_calls_by_flags_and_give_empty_tables(spark):
    from calltrail.sources.projects import TABLES, Flags, open_project

    text = "package org.x; import com.a.Known; class A { Fld f; void m(Arg a) { Loc l = new Loc(); f.x(); a.x(); l.x(); k.x(); Known.x(); bare(); ((C) z).x(); } }"
    files = spark.createDataFrame([("A.java", text), ("B.java", "class B { void m( }"), ("C.java", None)], "path STRING, text STRING")
    got = {(r.call, r.kept_by) for r in open_project("java", files).calls().collect()}
    assert got == {("Fld.x()", "field"), ("Arg.x()", "parameter"), ("Loc.x()", "typed"), ("Loc.Loc()", "constructor"), ("k.x()", None), ("Known.x()", "imported_root"), ("A.bare()", "include_unqualified"), ("C.x()", "typed")}
    off = open_project("java", files, flags=Flags(False, False, False, False))
    assert {(r.call, r.kept_by) for r in off.calls().collect()} == {("Fld.x()", "field"), ("Arg.x()", "typed"), ("Loc.x()", "typed"), ("Loc.Loc()", "constructor"), ("k.x()", None), ("Known.x()", "imported_root"), ("C.x()", "typed")}
    assert {r.path for r in off.fallback().collect()} == {"B.java"}
    script = open_project("script", files)
    for name in TABLES:
        if name != "calls":
            assert getattr(script, name)().collect() == []
    for name in TABLES:
        assert getattr(off, name)().columns == [c.split()[0] for c in TABLES[name].replace("ARRAY<STRING>", "ARRAY").split(", ")]
    with pytest.raises(KeyError):
        open_project("cobol", files)
