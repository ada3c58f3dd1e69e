"""Queries over parsed sources. Sources are generated from the tables, so each check is SQL on the tables alone.

A supplier is a class in its nation's package; the class has a method for each of its twenty parts.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.jobs.fixtures import Tables
from calltrail.jobs.registry import query
from calltrail.operators import graph, lookup, ordering, resolution, spans
from calltrail.operators.shared import materialize, new_path
from calltrail.sources import files as S
from calltrail.sources import adapters, java, settings

#: Lines of a generated method, its annotation's line with it.
METHOD_LINES = 14


def s_(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def fill(text: str, **values: Column) -> Column:
    """The text with «name» as columns."""
    parts = []
    for k, p in enumerate(text.replace("»", "«").split("«")):
        parts.append(F.lit(p) if k % 2 == 0 else values[p].cast("string"))
    return F.concat(*parts)


METHOD = """    @Transactional(readOnly = true, value = "a)b")
    public Svc«t» m«s»(final int a«s», @Valid List<String> b, Svc«t»[] c) throws IOException {
        Svc«t» v«s» = new Svc«t»(a«s»);
        // Old old«s» = commented.call(); {
        String text«s» = "brace } ( in \\"string" + '{';

        v«s».run«u»(a«s», local«s»(b));
        repo.find(a«s»).next();
        this.repo.save(v«s»);
        this.helper();
        if (a«s» > 0) { throw new Ex«u»("bad"); }
        for (Item item : b) { item.close(); }
        return v«s»;
    }
"""
CLASS = """package com.app.r«r»; /* plain
  words */ // tail

    // head: { alone }
import com.app.r«r».Unit«left»;
import com.app.r«r».Unit«right»;
import com.app.util.*;
import static com.app.Consts.MAX;
import org.ext«e».Lib«e»;
/* block { comment } */
@«ann»
public class Unit«k» extends Unit«half»«impl» {
    @Value("${unit.k«k»}")
    private String prop«k»;
    private final Map<String, List<Item>> cache = new HashMap<>();
    @Autowired
    private Repo«q» repo;
    public Unit«k»(int a) { this.a = a; }
«methods»    @Schedule(minute = "*") private void helper() { }
    void over(int a) { }
    void over(int a, String b) {
        int x = 1, y = a;
    }
    void over(String a, long b) {

        ((Port) this.port[0]).shut();
    }
    enum Kind { A(1), B { void x() { } }; int code; }
    interface Port { int open(String host);
        void shut(); }
«broken»}
"""


def sources(t: Tables) -> DataFrame:
    """path, text: a file for each supplier, so that files grow in number and not in length. Each seventh has a bracket too many.

    Sides of the join are keys, and texts are written behind it: Spark reckons texts that it has not written yet as small,
    and would gather all of them in the driver. Files are spread over as many tasks as shuffles have, as keys alone look
    like work for one.
    """
    parts = t.part.groupBy(F.floor(F.col("p_partkey") / 20).alias("s_suppkey")).agg(F.array_sort(F.collect_list("p_partkey")).alias("parts"))
    methods = F.array_join(F.transform("parts", lambda s: fill(METHOD, s=s, t=s % 5, u=s % 3)), "")
    k, r = F.col("s_suppkey"), F.col("s_nationkey")
    ann = F.element_at(F.array(*[F.lit(x) for x in ("Stateless", "WebServlet(\"/n\")", "Service", "MessageDriven")]), (k % 4 + 1).cast("int"))
    text = fill(CLASS, r=r, k=k, left=2 * k + 1, right=2 * k + 2, e=k % 3, half=F.floor(k / 2), q=k % 4, ann=ann, impl=F.when(k % 3 == 0, fill(" implements Api«r», Port", r=r)).otherwise(F.lit("")), methods=F.coalesce(methods, F.lit("")), broken=F.when(k % 7 == 6, F.lit(") \n")).otherwise(F.lit("")))
    units = t.supplier.select("s_suppkey", "s_nationkey").repartition(int(t.spark.conf.get("spark.sql.shuffle.partitions")), "s_suppkey")
    return units.join(parts.hint("merge"), "s_suppkey", "left").select(fill("src/r«r»/Unit«k».java", r=r, k=k).alias("path"), text.alias("text"))


def facts(t: Tables, **options) -> DataFrame:
    return java.parse_sources(sources(t), **options)


def kind(t: Tables, name: str) -> DataFrame:
    """Rows of files that parse."""
    return facts(t, kinds=(name,)).where(~F.col("fallback"))


_UNITS = "(SELECT s_suppkey AS k, s_nationkey AS r FROM supplier)"
_GOOD = f"(SELECT * FROM {_UNITS} WHERE k % 7 <> 6)"
_PARTS = "(SELECT p_partkey AS s, p_partkey % 5 AS t, p_partkey % 3 AS u, p_partkey // 20 AS k FROM part)"
_METHODS = f"(SELECT s, t, u, 'Unit' || k AS cls, k FROM {_PARTS} JOIN {_GOOD} USING (k))"
_ALL_METHODS = f"(SELECT s, t, u, 'Unit' || k AS cls, k FROM {_PARTS} JOIN {_UNITS} USING (k))"
_PATH = "'src/r' || r || '/Unit' || k || '.java'"


@query("parse_units", f"SELECT {_PATH} AS path, k % 7 = 6 AS failed FROM {_UNITS}")
def parse_units(t: Tables) -> DataFrame:
    return facts(t).groupBy("path").agg(F.bool_or(F.col("kind") == "error").alias("failed"))


@query("package_name", f"SELECT 'Unit' || k AS cls, 'com.app.r' || r AS package FROM {_UNITS}")
def package_name(t: Tables) -> DataFrame:
    """By pattern over the text: this needs no parse."""
    return sources(t).select(F.regexp_extract("path", "(Unit[0-9]+)", 1).alias("cls"), F.regexp_extract("text", r"(?m)^\s*package\s+([A-Za-z0-9_.]+)\s*;", 1).alias("package"))


@query("declared_types", f"SELECT 'Unit' || k AS cls, CASE WHEN k % 3 = 0 THEN 'class_implements_interface' ELSE 'class' END AS type, 'Unit' || (k // 2) AS extends FROM {_GOOD} UNION ALL SELECT 'Kind', 'enum', NULL FROM {_GOOD} UNION ALL SELECT 'Port', 'interface', NULL FROM {_GOOD}")
def declared_types(t: Tables) -> DataFrame:
    return kind(t, "type").where("type <> 'fallback' AND line IS NOT NULL").select("cls", "type", F.col("name").alias("extends"))


@query("type_members", f"SELECT cls, 'm' || s AS mth FROM {_METHODS} UNION ALL SELECT 'Unit' || k, unnest(['Unit' || k, 'helper', 'over', 'over', 'over']) FROM {_GOOD} UNION ALL SELECT 'Port', unnest(['open', 'shut']) FROM {_GOOD}")
def type_members(t: Tables) -> DataFrame:
    """Members of the innermost type."""
    return kind(t, "method").select("cls", "mth")


@query("method_metadata", f"SELECT 'm' || s AS mth, 'Svc' || t AS returns, 'Public' AS access, CAST(3 AS INTEGER) AS arity, 'int;List<String>;Svc' || t || '[]' AS params, '@Transactional(readOnly = true, value = \"a)b\")' AS ann FROM {_METHODS} UNION ALL SELECT 'Unit' || k, 'constructor', 'Public', 1, 'int', NULL FROM {_GOOD}")
def method_metadata(t: Tables) -> DataFrame:
    m = kind(t, "method").where("mth LIKE 'm%' OR type = 'constructor'")
    return m.select("mth", F.col("type").alias("returns"), F.col("name").alias("access"), F.col("n").alias("arity"), F.col("extra").alias("params"), "ann")


@query("param_types", f"SELECT 'm' || s AS mth, CAST(p AS INTEGER) AS pos, ['int', 'list<string>', 'svc' || t || '[]'][p + 1] AS type FROM {_METHODS}, range(0, 3) x(p)")
def param_types(t: Tables) -> DataFrame:
    m = kind(t, "method").where("mth LIKE 'm%'").select("mth", F.posexplode(F.split("extra", ";")).alias("pos", "type"))
    return m.select("mth", "pos", T.normal_type(F.col("type")).alias("type"))


@query("imports_classified", f"SELECT 'Unit' || k AS cls, unnest(['com.app.r' || r || '.Unit' || (2 * k + 1), 'com.app.r' || r || '.Unit' || (2 * k + 2), 'com.app.util', 'com.app.Consts.MAX']) AS name, unnest(['type', 'type', 'wildcard', 'static']) AS type FROM {_GOOD}")
def imports_classified(t: Tables) -> DataFrame:
    """Imports of the user's own packages, in four kinds."""
    return kind(t, "import").where(F.col("name").startswith("com.")).select(F.regexp_extract("path", "(Unit[0-9]+)", 1).alias("cls"), "name", "type")


@query("external_imports", f"SELECT DISTINCT 'Unit' || k AS file, 'Lib' || (k % 3) AS cls FROM {_GOOD}")
def external_imports(t: Tables) -> DataFrame:
    own = kind(t, "import").where((F.col("type") == "type") & ~F.col("name").startswith("com."))
    return own.select(F.regexp_extract("path", "(Unit[0-9]+)", 1).alias("file"), T.simple_type(F.col("name")).alias("cls")).distinct()


@query("field_types", f"SELECT 'Unit' || k AS cls, unnest(['prop' || k, 'cache', 'repo']) AS name, unnest(['String', 'Map<String,List<Item>>', 'Repo' || (k % 4)]) AS type FROM {_GOOD} UNION ALL SELECT 'Kind', 'code', 'int' FROM {_GOOD}")
def field_types(t: Tables) -> DataFrame:
    return kind(t, "field").select("cls", "name", "type")


@query("var_types", f"SELECT 'm' || s AS mth, unnest(['a' || s, 'b', 'c', 'v' || s, 'text' || s, 'item']) AS name, unnest(['int', 'List<String>', 'Svc' || t || '[]', 'Svc' || t, 'String', 'Item']) AS type, unnest(['param', 'param', 'param', 'local', 'local', 'for']) AS how FROM {_METHODS}")
def var_types(t: Tables) -> DataFrame:
    return kind(t, "var").where("mth LIKE 'm%'").select("mth", "name", "type", F.col("extra").alias("how"))


def called(t: Tables, include_unqualified: bool = True) -> DataFrame:
    """Call rows of all files: sites of one parse, written once, with their roots typed by joins."""
    return resolution.resolved_calls(materialize(facts(t, kinds=("site", "call", "var", "field"))), include_unqualified)


def calls(t: Tables, *how: str) -> DataFrame:
    """Calls of files that parse, of all methods, constructors and overloads."""
    return called(t).where(F.col("type").isin(*how) & ~F.col("fallback")).select("mth", F.col("name").alias("call"))


_CALLS = {
    "sibling": [f"SELECT 'm' || s AS mth, cls || '.' || unnest(['local' || s, 'helper']) || '()' AS call FROM {_METHODS}"],
    "qualified": [f"SELECT 'm' || s AS mth, unnest(['Svc' || t || '.run' || u, 'Repo' || (k % 4) || '.find', 'Item.close']) || '()' AS call FROM {_METHODS} UNION ALL SELECT 'over', 'Port.shut()' FROM {_GOOD}"],
    "chain": [f"SELECT 'm' || s AS mth, 'Repo' || (k % 4) || '.find().next()' AS call FROM {_METHODS}"],
    "this_field": [f"SELECT 'm' || s AS mth, 'Repo' || (k % 4) || '.save()' AS call FROM {_METHODS}"],
    "ctor": [f"SELECT 'm' || s AS mth, 'Svc' || t || '.Svc' || t || '()' AS call FROM {_METHODS}"],
    "throw": [f"SELECT 'm' || s AS mth, 'Ex' || u || '.Ex' || u || '()' AS call FROM {_METHODS}"],
}
_ALL_CALLS = " UNION ALL ".join(x for v in _CALLS.values() for x in v)

for _name, _how in (("calls_sibling", "sibling"), ("calls_qualified", "qualified"), ("calls_chain", "chain"), ("calls_this_field", "this_field"), ("calls_ctor", "ctor"), ("calls_throw", "throw")):
    query(_name, _CALLS[_how][0])(lambda t, how=_how: calls(t, how))


@query("calls_raw", f"SELECT DISTINCT mth, call FROM ({_ALL_CALLS})")
def calls_raw(t: Tables) -> DataFrame:
    return calls(t, *_CALLS).distinct()


@query("calls_nested_args", f"SELECT 'm' || s AS mth, cls || '.local' || s || '()' AS call FROM {_METHODS}")
def calls_nested_args(t: Tables) -> DataFrame:
    """Calls among the arguments of another call: round brackets behind a name are bodies of it, and each call has its
    innermost one. Brackets of conditions and groups are none."""
    files_ = materialize(sources(t))
    f = materialize(java.parse_sources(files_).where("kind IN ('site', 'var', 'field') AND NOT fallback"))
    found = materialize(resolution.resolved_calls(f))
    w = Window.partitionBy("path").orderBy("pos")
    marks = java.all_tokens(files_).select("path", "text", "kind", F.lag("text").over(w).alias("name"), F.lag("kind").over(w).alias("before"), F.lag("text", 2).over(w).alias("before2"), "pos")
    round_ = marks.where("kind = 'mark' AND text IN ('(', ')')")
    opens = F.col("text") == "("
    named = opens & (F.col("before") == "word") & ~F.col("name").isin(*T.CONTROL_WORDS) & (F.coalesce("before2", F.lit("")) != "@")
    none = F.lit(None).cast("string")
    tokens = round_.where(named).select("path", F.lit("decl").alias("kind"), "name", none.alias("recv"), (F.col("pos") * 2).alias("pos"))
    tokens = tokens.unionByName(round_.select("path", F.when(opens, "open").otherwise("close").alias("kind"), none.alias("name"), none.alias("recv"), (F.col("pos") * 2 + 1).alias("pos")))
    asks = found.select("path", F.lit("call").alias("kind"), none.alias("name"), none.alias("recv"), (F.col("pos") * 2).alias("pos")).distinct()
    inside = spans.with_scope(tokens.unionByName(asks)).where("opened IS NOT NULL").select("path", (F.col("pos") / 2).cast("long").alias("pos"))
    return found.join(inside, ["path", "pos"], "left_semi").select("mth", F.col("name").alias("call"))


def bodies(t: Tables, f: DataFrame) -> DataFrame:
    """body, path, cls, mth, source of all methods: their lines, without comments and literals. f: rows of the scanner."""
    own = f.where("kind = 'method'").groupBy("path").agg(F.collect_list(F.struct(_body("extra").alias("body"), "cls", "mth", "line", "end")).alias("of"))
    texts = sources(t).select("path", F.split("text", "\n").alias("lines"))  # a text meets its methods once, not a copy each
    cut = F.transform("of", lambda m: F.struct(m["body"].alias("body"), m["cls"].alias("cls"), m["mth"].alias("mth"), F.array_join(F.slice("lines", m["line"], m["end"] - m["line"] + 1), "\n").alias("raw")))
    return own.hint("merge").join(texts, "path").select("path", F.inline(cut)).select("body", "path", "cls", "mth", blank(F.col("raw"), True, " ").alias("source"))


def _body(params: str) -> Column:
    """Names a method's body; its parameter types tell overloads apart."""
    return F.concat_ws("|", "path", "cls", "mth", F.coalesce(params, F.lit("")))


def _variables(f: DataFrame) -> DataFrame:
    return f.where("kind = 'var'").select(_body("ann").alias("body"), "name", "type", F.when(F.col("extra") == "param", "param").otherwise(F.col("extra")).alias("how"))


def _named(f: DataFrame) -> DataFrame:
    """body, mth: names that the scanner's qualified calls have."""
    return f.where("kind = 'call' AND type <> 'dynamic'").select(_body("ann").alias("body"), F.explode(F.regexp_extract_all("name", F.lit(r"\.([A-Za-z_]\w*)\("), F.lit(1))).alias("mth"))


@query("calls_regex_chain", f"SELECT 'm' || s AS mth, unnest(['Repo' || (k % 4) || '.find(a' || s || ').next()', 'Repo' || (k % 4) || '.save(v' || s || ')', 'Item.close()']) AS call, 'rewritten' AS how FROM {_ALL_METHODS}")
def calls_regex_chain(t: Tables) -> DataFrame:
    """Chains by pattern over bodies without comments and literals, roots rewritten to types; next() is a bare name on a
    result, and goes as a qualified call has it."""
    f = materialize(facts(t, kinds=("method", "var", "field", "call", "site")))
    found = resolution.chain_calls(bodies(t, f), _variables(f), f.where("kind = 'field'").select("cls", "name", "type"), _named(resolution.resolved_calls(f)))
    return found.select(F.element_at(F.split("body", r"\|"), 3).alias("mth"), "call", "how")


@query("calls_fallback", f"SELECT mth, call, how FROM ({' UNION ALL '.join(f'SELECT mth, call, {chr(39)}{h}{chr(39)} AS how FROM ({v[0]})' for h, v in _CALLS.items())})".replace(_METHODS, f"(SELECT * FROM {_ALL_METHODS} WHERE k % 7 = 6)").replace(_GOOD, f"(SELECT * FROM {_UNITS} WHERE k % 7 = 6)"))
def calls_fallback(t: Tables) -> DataFrame:
    """Calls of files that do not parse, from the scan that lets the odd bracket be: with types, constructors, throws and chains."""
    return called(t).where("fallback").select("mth", F.col("name").alias("call"), F.col("type").alias("how"))


@query("calls_dynamic", "SELECT 'm' || p_partkey AS mth, 'g' || (p_partkey % 7) || '()' AS call FROM part")
def calls_dynamic(t: Tables) -> DataFrame:
    """f(...).g(): what is called on a result whose type is unknown."""
    p = F.col("p_partkey")
    files = t.part.select(fill("P«p».java", p=p).alias("path"), fill("class P«p» { void m«p»() { make(«p»).g«g»(x.y); } }", p=p, g=p % 7).alias("text"))
    return resolution.resolved_calls(materialize(java.parse_sources(files))).where("type = 'dynamic'").select("mth", F.col("name").alias("call"))


@query("adapter_flags", f"SELECT mth, call FROM ({' UNION ALL '.join(v[0] for h, v in _CALLS.items() if h != 'sibling')}) UNION ALL SELECT 'm' || s, cls || '.helper()' FROM {_METHODS}")
def adapter_flags(t: Tables) -> DataFrame:
    """Without bare calls; this.helper() names its class and stays."""
    return called(t, include_unqualified=False).where("NOT fallback").select("mth", F.col("name").alias("call"))


_CHAIN_CALLS = f"SELECT 'm' || s AS mth, unnest(['Repo' || (k % 4) || '.find(a' || s || ').next()', 'Repo' || (k % 4) || '.save(v' || s || ')', 'Item.close()']) AS call FROM {_METHODS}"


@query("lineage_rows", f"SELECT cls, mth, params, call FROM (SELECT DISTINCT c.mth, c.call, m.cls, 'int;List<String>;Svc' || m.t || '[]' AS params FROM ({_ALL_CALLS} UNION ALL {_CHAIN_CALLS}) c JOIN {_METHODS} m ON c.mth = 'm' || m.s) UNION ALL SELECT 'Unit' || k, unnest(['Unit' || k, 'helper', 'over', 'over', 'over']), unnest(['int', '', 'int', 'int;String', 'String;long']), unnest(['None', 'None', 'None', 'None', 'Port.shut()']) FROM {_GOOD} UNION ALL SELECT 'Port', unnest(['open', 'shut']), unnest(['String', '']), 'None' FROM {_GOOD}".replace(_METHODS, _ALL_METHODS).replace(_GOOD, _UNITS))
def lineage_rows(t: Tables) -> DataFrame:
    """A row for each distinct call of a method; methods without calls keep one row, overloads their own. Calls are the
    scanner's, and chains with what they claim; files that do not parse give what their second scan finds. One parse."""
    f = materialize(facts(t, kinds=("method", "call", "site", "var", "field")))
    found = materialize(resolution.resolved_calls(f))
    scanned = found.select(_body("ann").alias("body"), F.col("name").alias("call"))
    chained = resolution.chain_calls(bodies(t, f), _variables(f), f.where("kind = 'field'").select("cls", "name", "type"), _named(found)).select("body", "call")
    sets = scanned.unionByName(chained).groupBy("body").agg(F.collect_set("call").alias("calls"))
    rows = f.where("kind = 'method'").select(_body("extra").alias("body"), "cls", "mth", F.coalesce("extra", F.lit("")).alias("params")).join(sets.hint("merge"), "body", "left")
    return rows.select("cls", "mth", "params", F.explode_outer("calls").alias("call")).select("cls", "mth", "params", F.coalesce("call", F.lit("None")).alias("call"))


_ENTRY = "CASE k % 4 WHEN 0 THEN 'EJB_SLSB' WHEN 1 THEN 'SERVLET' WHEN 3 THEN 'EJB_MDB' ELSE 'GENERAL' END"


@query("method_inventory", f"""SELECT cls, 'm' || s AS mth, CAST({METHOD_LINES} AS INTEGER) AS loc, 'Unit' || (k // 2) AS parent, {_ENTRY} AS entry_type, 'int a' || s || ', List b, Svc' || t || '[] c' AS args FROM {_METHODS}
    UNION ALL SELECT 'Unit' || k, unnest(['Unit' || k, 'over', 'over', 'over', 'helper']), unnest([1, 1, 3, 4, 1]), 'Unit' || (k // 2), unnest([{_ENTRY}, {_ENTRY}, {_ENTRY}, {_ENTRY}, 'SCHEDULED']), unnest(['int a', 'int a', 'int a, String b', 'String a, long b', '']) FROM {_GOOD}
    UNION ALL SELECT 'Port', unnest(['open', 'shut']), 1, NULL, 'GENERAL', unnest(['String host', '']) FROM {_GOOD}""")
def method_inventory(t: Tables) -> DataFrame:
    """Constructors and methods of all types, nested ones too, with their parameters as written."""
    f = materialize(facts(t, kinds=("method", "type", "var")).where("NOT fallback"))
    types = f.where("kind = 'type'").select("path", "cls", F.col("name").alias("parent"), entry_type(F.col("ann"), F.col("name"), F.col("extra")).alias("entry_type"))
    params = f.where("kind = 'var' AND extra = 'param'").groupBy("path", "cls", "mth", F.col("ann").alias("extra")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", T.strip_generics(F.col("type")).alias("type"), "name"))), lambda x: F.concat(x["type"], F.lit(" "), x["name"])), ", ").alias("args")
    )
    methods = f.where("kind = 'method'").select("path", "cls", "mth", F.coalesce("extra", F.lit("")).alias("extra"), "ann", (F.col("end") - F.col("line") + 1).alias("loc"))
    rows = methods.join(types.hint("merge"), ["path", "cls"]).join(params.hint("merge"), ["path", "cls", "mth", "extra"], "left")
    return rows.select("cls", "mth", "loc", "parent", F.when(is_scheduled(F.col("ann")), F.lit("SCHEDULED")).otherwise(F.col("entry_type")).alias("entry_type"), F.coalesce("args", F.lit("")).alias("args"))


#: Entry types by annotation of a class, and by what it extends.
ENTRY_BY_ANNOTATION = {
    "Stateless": "EJB_SLSB", "Stateful": "EJB_SFSB", "Singleton": "EJB_SINGLETON", "MessageDriven": "EJB_MDB", "WebServlet": "SERVLET", "WebFilter": "FILTER", "WebListener": "LISTENER",
    "ServerEndpoint": "WEBSOCKET", "Path": "JAX_RS", "ApplicationPath": "JAX_RS", "ApplicationScoped": "CDI", "RequestScoped": "CDI", "SessionScoped": "CDI", "Dependent": "CDI",
}
ENTRY_BY_PARENT = {"HttpServlet": "SERVLET", "GenericServlet": "SERVLET"}


def entry_type(annotations: Column, parent: Column, interfaces: Column) -> Column:
    """By the first known annotation, then the parent, then MessageListener, else GENERAL."""
    names = F.regexp_extract_all(annotations, F.lit(r"@([A-Za-z]+)"), F.lit(1))
    table = F.create_map(*[F.lit(x) for pair in ENTRY_BY_ANNOTATION.items() for x in pair])
    parents = F.create_map(*[F.lit(x) for pair in ENTRY_BY_PARENT.items() for x in pair])
    first = F.get(F.filter(F.transform(names, lambda n: F.element_at(table, n)), lambda x: x.isNotNull()), F.lit(0))
    listener = F.array_contains(F.split(F.coalesce(interfaces, F.lit("")), ";"), "MessageListener")
    return F.coalesce(first, F.element_at(parents, parent), F.when(listener, F.lit("EJB_MDB")), F.lit("GENERAL"))


def is_scheduled(annotations: Column) -> Column:
    """A method's own schedule goes before what its class says."""
    return F.coalesce(annotations.rlike(r"(^|;)@Schedules?\b"), F.lit(False))


@query("entry_type", f"SELECT 'Unit' || k AS cls, CASE k % 4 WHEN 0 THEN 'EJB_SLSB' WHEN 1 THEN 'SERVLET' WHEN 3 THEN 'EJB_MDB' ELSE 'GENERAL' END AS entry_type FROM {_GOOD}")
def entry_types(t: Tables) -> DataFrame:
    return kind(t, "type").where("cls LIKE 'Unit%' AND line IS NOT NULL").select("cls", entry_type(F.col("ann"), F.col("name"), F.col("extra")).alias("entry_type"))


@query("method_loc", f"SELECT 'm' || s AS mth, CAST({METHOD_LINES} AS INTEGER) AS loc, CAST({METHOD_LINES - 1} AS INTEGER) AS filled FROM {_METHODS} UNION ALL SELECT unnest(['helper', 'over', 'over', 'over']), unnest([1, 1, 3, 4]), unnest([1, 1, 3, 3]) FROM {_GOOD} UNION ALL SELECT 'open', 1, 1 FROM {_GOOD} UNION ALL SELECT 'shut', 1, 1 FROM {_GOOD} UNION ALL SELECT 'Unit' || k, 1, 1 FROM {_GOOD}")
def method_loc(t: Tables) -> DataFrame:
    """Lines from a method's first annotation to its last brace or semicolon, all and without blank ones."""
    n = F.col("end") - F.col("line") + 1
    own = F.slice(F.split("text", "\n"), F.col("line"), n)
    return kind(t, "method").select("path", "mth", "line", "end").join(sources(t), "path").select("mth", n.alias("loc"), F.size(F.filter(own, lambda x: F.trim(x) != "")).alias("filled"))


@query("loc_with_annotations", f"SELECT 'm' || s AS mth, CAST({METHOD_LINES} AS INTEGER) AS with_annotations, CAST({METHOD_LINES - 1} AS INTEGER) AS without FROM {_METHODS}")
def loc_with_annotations(t: Tables) -> DataFrame:
    loc = F.col("end") - F.col("line") + 1
    above = F.length("ann") - F.length(F.replace("ann", F.lit("\n"))) + 1
    return kind(t, "method").where("ann IS NOT NULL AND mth LIKE 'm%'").select("mth", loc.alias("with_annotations"), (loc - above).alias("without"))


@query("loc_interface", f"SELECT 'Port' AS cls, unnest(['open', 'shut']) AS mth, CAST(1 AS INTEGER) AS loc FROM {_GOOD}")
def loc_interface(t: Tables) -> DataFrame:
    """Methods without a body end at their semicolon, not at the next method's brace."""
    return kind(t, "method").where("cls = 'Port'").select("cls", "mth", (F.col("end") - F.col("line") + 1).alias("loc"))


def method_text(t: Tables) -> DataFrame:
    """mth, source: the lines of each method."""
    f = kind(t, "method").where("mth LIKE 'm%'").select("path", "mth", "line", "end")
    lines = F.split("text", "\n")
    return f.join(sources(t), "path").select("mth", F.array_join(F.slice(lines, F.col("line"), F.col("end") - F.col("line") + 1), "\n").alias("source"))


_METHOD_SQL = "'" + METHOD.rstrip("\n").replace("'", "''").replace("«s»", "' || s || '").replace("«t»", "' || t || '").replace("«u»", "' || u || '") + "'"


@query("method_source", f"SELECT 'm' || s AS mth, md5({_METHOD_SQL}) AS digest FROM {_METHODS}")
def method_source(t: Tables) -> DataFrame:
    return method_text(t).select("mth", F.md5("source").alias("digest"))


@query("brace_match", f"SELECT 'm' || s AS mth, CAST(unnest([2, 11, 12]) AS INTEGER) AS opens, CAST(unnest([{METHOD_LINES}, 11, 12]) AS INTEGER) AS closes FROM {_METHODS}")
def brace_match(t: Tables) -> DataFrame:
    """Lines of a method's braces with those of their partners: the next closing one of the same depth."""
    methods = kind(t, "method").where("mth LIKE 'm%'").select("path", "mth", "line", "end")
    marks = java.all_tokens(sources(t), marks="{}")
    found = spans.with_partners(marks).select("path", F.col("line").alias("opens"), F.col("close_line").alias("closes"))
    return found.join(methods.hint("merge"), "path").where("opens BETWEEN line AND end").select("mth", (F.col("opens") - F.col("line") + 1).alias("opens"), (F.col("closes") - F.col("line") + 1).alias("closes"))


@query("method_positions", f"SELECT 'm' || s AS mth, CAST(row_number() OVER (PARTITION BY cls ORDER BY s) AS INTEGER) AS nr FROM {_METHODS}")
def method_positions(t: Tables) -> DataFrame:
    return kind(t, "method").where("mth LIKE 'm%'").select("mth", F.row_number().over(Window.partitionBy("path").orderBy("pos")).alias("nr"))


@query("type_to_file", f"SELECT name, path FROM (SELECT 'Unit' || k AS name, {_PATH} AS path FROM {_UNITS} UNION ALL SELECT unnest(['Kind', 'Port']), min({_PATH}) FROM {_UNITS})")
def type_to_file(t: Tables) -> DataFrame:
    """File stems and declared types; the first path wins."""
    f = facts(t)
    return S.type_index(f.select("path"), f.where("kind = 'type' AND type <> 'anonymous'").select("path", "cls")).select(F.col("key").alias("name"), "path")


#: Files named Repo«n», some with an implementation elsewhere or nothing but that, and some that only a type's declaration leads to.
_INDEXED = """(SELECT n, 'src/' || (p % 5) || '/Repo' || n || suffix || '.java' AS path, 'Repo' || n || suffix AS stem, 'In' || n || CASE WHEN p % 2 = 0 THEN 'Impl' ELSE '' END AS inner_
    FROM (SELECT p_partkey AS p, p_partkey // 3 AS n, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Impl' ELSE 'Other' END AS suffix FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0))"""


@query("type_index", f"""WITH f AS (SELECT * FROM {_INDEXED}), r AS (SELECT stem AS key, 0 AS prio, path, 'stem' AS how FROM f UNION ALL SELECT left(stem, len(stem) - 4), 1, path, 'stem of implementation' FROM f WHERE stem LIKE '%Impl'
    UNION ALL SELECT inner_, 2, path, 'type' FROM f UNION ALL SELECT left(inner_, len(inner_) - 4), 3, path, 'type of implementation' FROM f WHERE inner_ LIKE '%Impl' UNION ALL SELECT stem, 2, path, 'type' FROM f)
    SELECT key, arg_min(path, (prio, path)) AS path, arg_min(how, (prio, path)) AS how FROM r GROUP BY 1""")
def type_index(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    rows = t.part.where((p % 3 != 0) | (p % 2 == 0)).select(fill("Repo«n»«s»", n=F.floor(p / 3), s=F.when(p % 3 == 0, "").when(p % 3 == 1, "Impl").otherwise("Other")).alias("stem"), fill("In«n»«s»", n=F.floor(p / 3), s=F.when(p % 2 == 0, "Impl").otherwise("")).alias("inner"), (p % 5).alias("d"))
    files_ = rows.select(fill("src/«d»/«s».java", d=F.col("d"), s=F.col("stem")).alias("path"), "stem", "inner")
    return S.type_index(files_.select("path"), files_.select("path", F.explode(F.array("stem", "inner")).alias("cls")))


@query("iface_impl", "SELECT 'Repo' || p_partkey AS iface, 'Repo' || p_partkey || 'Impl' AS impl FROM part WHERE p_partkey % 3 = 0")
def iface_impl(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    names = t.part.select(fill("src/«n»«p»«i».java", p=p, n=F.when(p % 3 == 0, F.lit("Repo")).otherwise(F.lit("Svc")), i=F.when(p % 3 == 0, F.lit("Impl")).otherwise(F.lit(""))).alias("path"))
    stems = names.select(T.file_stem(F.col("path")).alias("impl")).where(F.col("impl").endswith("Impl"))
    return stems.select(F.expr("left(impl, length(impl) - 4)").alias("iface"), "impl").distinct()


@query("object_class_map", f"SELECT DISTINCT 'unit' || k || '.java' AS file, name, type FROM (SELECT k, unnest(['b', 'v' || s, 'item']) AS name, unnest(['List<String>', 'Svc' || t, 'Item']) AS type FROM {_METHODS})")
def object_class_map(t: Tables) -> DataFrame:
    """(file, variable) to type: the first wins, a collection gives way."""
    v = kind(t, "var").where("mth LIKE 'm%' AND (name IN ('b', 'item') OR name LIKE 'v%')")
    own = v.select(F.lower(F.regexp_replace("path", "^.*/", "")).alias("file"), F.lower("name").alias("name"), "type", "pos")
    return lookup.variable_types(own, ["file", "name"]).select("file", "name", F.col("var_type").alias("type"))


@query("bfs_var_map", f"""SELECT 'Unit' || k AS cls, unnest(['prop' || k, 'repo', 'a', 'b', 'host']) AS var, unnest(['String', 'Repo' || (k % 4), 'String', 'String', 'String']) AS type FROM {_UNITS}
    UNION ALL SELECT 'Unit' || k, unnest(['v' || s, 'text' || s, 'old' || s]), unnest(['Svc' || t, 'String', 'Old']) FROM {_PARTS} JOIN {_UNITS} USING (k)""")
def bfs_var_map(t: Tables) -> DataFrame:
    """All declarations by pattern: a capitalised type before a name and "=", ";", "," or ")"; fields, variables and
    parameters, the last of a name winning. Comments count too, and type arguments go."""
    pattern = r"([A-Z][A-Za-z0-9_]*(?:<[^>]+>)?)\s+([a-z][A-Za-z0-9_]*)\s*[=;,)]"
    found = F.posexplode(F.arrays_zip(F.regexp_extract_all("text", F.lit(pattern), F.lit(1)).alias("type"), F.regexp_extract_all("text", F.lit(pattern), F.lit(2)).alias("var"))).alias("pos", "d")
    pairs = sources(t).select(F.regexp_extract("path", "(Unit[0-9]+)", 1).alias("cls"), found)
    return pairs.groupBy("cls", F.col("d.var").alias("var")).agg(F.max_by(T.strip_generics(F.col("d.type")), "pos").alias("type"))


@query("method_return_index", f"SELECT cls, 'm' || s AS mth, 'Svc' || t AS ret, 'Unit' || (k // 2) AS parent FROM {_METHODS}")
def method_return_index(t: Tables) -> DataFrame:
    f = materialize(facts(t, kinds=("method", "type")).where("NOT fallback"))
    ret = f.where("kind = 'method' AND mth LIKE 'm%'").groupBy("cls", "mth").agg(F.max_by("type", F.struct("path", "pos")).alias("ret"))
    return ret.join(f.where("kind = 'type'").select("cls", F.col("name").alias("parent")), "cls").select("cls", "mth", "ret", "parent")


@query("normalize_qualifier", "SELECT s_suppkey, 'v' || s_suppkey AS qualifier FROM supplier")
def normalize_qualifier(t: Tables) -> DataFrame:
    """A doubled variable name is the variable."""
    known = t.supplier.select(F.concat(F.lit("v"), s_("s_suppkey")).alias("var"))
    calls_ = t.supplier.select("s_suppkey", fill("v«s»«d»", s=F.col("s_suppkey"), d=F.when(F.col("s_suppkey") % 2 == 0, fill("v«s»", s=F.col("s_suppkey"))).otherwise(F.lit(""))).alias("q"))
    return calls_.join(known.withColumn("q", F.concat("var", "var")), "q", "left").select("s_suppkey", F.coalesce("var", "q").alias("qualifier"))


def _kept(t: Tables, calls_: Column) -> DataFrame:
    """mth, root, called, kept_by of calls (root, called) in all bodies. Files of even suppliers belong to an application
    that keeps bare calls, the others to one without flags."""
    f = materialize(facts(t, kinds=("method", "var", "field", "import", "package")).where("NOT fallback"))
    unit = F.regexp_extract("path", "Unit([0-9]+)", 1).cast("long")
    asked = bodies(t, f).select((unit % 2).alias("application"), "path", "cls", "body", F.col("mth").alias("of"), F.inline(F.array_distinct(calls_))).withColumnRenamed("called", "mth")
    flags = t.region.where("r_regionkey < 2").select(F.col("r_regionkey").cast("long").alias("application"), (F.col("r_regionkey") == 0).alias("include_unqualified"), *[F.lit(False).alias(x) for x in ("accept_local_new_types", "accept_parameter_types", "accept_same_package")])
    packages = f.where("kind = 'package'").select("path", F.col("name").alias("package"))
    index = resolution.import_index(f.where("kind = 'import'"))
    return resolution.keep_calls(asked, _variables(f), f.where("kind = 'field'").select("cls", "name"), index, packages, flags).select(F.col("of").alias("mth"), "root", F.col("mth").alias("called"), "kept_by")


@query("keep_qualified", f"SELECT 'm' || s AS mth, unnest(['v' || s, 'repo', 'item']) AS root, unnest(['wildcard', 'field', 'wildcard']) AS kept_by FROM {_METHODS}")
def keep_qualified(t: Tables) -> DataFrame:
    """Qualified calls by what keeps their root: a field, a local or parameter, an imported type, a wildcard, the package."""
    calls_ = F.transform(F.regexp_extract_all("source", F.lit(r"(?<![\w.)])([A-Za-z]\w*)\.[a-z]\w*\("), F.lit(1)), lambda r: F.struct(r.alias("root"), F.lit(None).cast("string").alias("called")))
    return _kept(t, calls_).where("kept_by IS NOT NULL").select("mth", "root", "kept_by")


@query("keep_unqualified", f"SELECT 'm' || s AS mth, 'local' || s AS called FROM {_METHODS} WHERE k % 2 = 0")
def keep_unqualified(t: Tables) -> DataFrame:
    """Bare calls stay where the application keeps them, or a static import names them."""
    names = F.filter(F.regexp_extract_all("source", F.lit(r"(?<![\w.])([a-z]\w*)\s*\("), F.lit(1)), lambda x: ~x.isin(*T.CONTROL_WORDS) & (x != F.col("mth")))
    calls_ = F.transform(names, lambda x: F.struct(F.lit(None).cast("string").alias("root"), x.alias("called")))
    return _kept(t, calls_).where("kept_by IS NOT NULL").select("mth", "called")


@query("skip_commented", f"SELECT 'm' || s AS mth, unnest(['v' || s, 'text' || s]) AS declared FROM {_METHODS}")
def skip_commented(t: Tables) -> DataFrame:
    """Declarations by pattern, line by line; those on commented lines go."""
    lines = method_text(t).select("mth", F.explode(F.split("source", "\n")).alias("l"))
    name = F.regexp_extract("l", r"\b[A-Z][A-Za-z0-9_]*\s+([a-z][A-Za-z0-9_]*)\s*=", 1)
    return lines.where(~T.commented(F.col("l"))).select("mth", name.alias("declared")).where("declared <> ''")


@query("skip_primitives", f"SELECT 'm' || s AS mth, unnest(['List<String>', 'Svc' || t || '[]']) AS type FROM {_METHODS} UNION ALL SELECT unnest(['over', 'over', 'open']), 'String' FROM {_GOOD}")
def skip_primitives(t: Tables) -> DataFrame:
    """Parameters whose type is none of the configured list."""
    return kind(t, "var").where("extra = 'param'").where(~F.col("type").isin(*_config(t).words("PRIMITIVE"))).select("mth", "type")


# --- stripping ----------------------------------------------------------------------------------------------------------


def blank(text: Column, literals: bool, fill_: str) -> Column:
    @F.pandas_udf("string")
    def strip(s: pd.Series) -> pd.Series:
        return s.map(lambda x: java.blanked(x, literals, fill_), na_action="ignore")

    return strip(text)


def _stripped(literals: bool, mark: str) -> str:
    """The generated method as SQL, without its comment line and, if asked, its literals."""
    text = METHOD.rstrip("\n").replace("// Old old«s» = commented.call(); {", mark)
    if literals:
        for x in ('"brace } ( in \\"string"', "'{'", '"bad"', '"a)b"'):
            text = text.replace(x, mark)
    return "'" + text.replace("'", "''").replace("«s»", "' || s || '").replace("«t»", "' || t || '").replace("«u»", "' || u || '") + "'"


for _name, _literals, _mark in (("strip_comments_literals", True, ""), ("strip_comments_keep_strings", False, ""), ("strip_to_space", True, " ")):
    query(_name, f"SELECT 'm' || s AS mth, md5({_stripped(_literals, _mark)}) AS digest FROM {_METHODS}")(
        lambda t, literals=_literals, mark=_mark: method_text(t).select("mth", F.md5(blank(F.col("source"), literals, mark)).alias("digest"))
    )


def _class_sql(text: str) -> str:
    """A generated source as SQL over rows of _UNITS with its methods."""
    values = {"r": "r", "k": "k", "left": "(2 * k + 1)", "right": "(2 * k + 2)", "e": "(k % 3)", "half": "(k // 2)", "q": "(k % 4)", "methods": "methods", "broken": "CASE WHEN k % 7 = 6 THEN ') ' || chr(10) ELSE '' END",
        "ann": "['Stateless', 'WebServlet(\"/n\")', 'Service', 'MessageDriven'][k % 4 + 1]", "impl": "CASE WHEN k % 3 = 0 THEN ' implements Api' || r || ', Port' ELSE '' END"}
    quoted = text.replace("'", "''")
    for name, value in values.items():
        quoted = quoted.replace(f"«{name}»", f"' || {value} || '")
    return f"'{quoted}'"


_TOP_CLASS = CLASS.replace("/* plain\n  words */", "").replace("\n\n    // head: { alone }", "\n")
_TOP_METHOD = METHOD.replace("        // Old old«s» = commented.call(); {", "").replace("'", "''").replace("«s»", "' || s || '").replace("«t»", "' || t || '").replace("«u»", "' || u || '")


@query("strip_top_level", f"SELECT cls, md5({_class_sql(_TOP_CLASS)}) AS digest FROM (SELECT 'Unit' || k AS cls, k, r, coalesce(methods, '') AS methods FROM {_UNITS} LEFT JOIN (SELECT k, string_agg('{_TOP_METHOD}', '' ORDER BY s) AS methods FROM {_PARTS} GROUP BY 1) USING (k))")
def strip_top_level(t: Tables) -> DataFrame:
    """The text without comments that stand on lines of their own, and without block comments that hold no brace."""
    return sources(t).select(F.regexp_extract("path", "(Unit[0-9]+)", 1).alias("cls"), F.md5(T.strip_top_level(F.col("text"))).alias("digest"))


# --- tokens and ranks ---------------------------------------------------------------------------------------------------


@query("decl_call_tokens", f"SELECT 'm' || s AS scope, unnest([NULL, 'v' || s, NULL, 'repo', NULL, 'repo', 'this', NULL, 'item']) AS recv, unnest(['Svc' || t, 'run' || u, 'local' || s, 'find', 'next', 'save', 'helper', 'Ex' || u, 'close']) AS callee, CAST(unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS INTEGER) AS rank FROM {_ALL_METHODS}")
def decl_call_tokens(t: Tables) -> DataFrame:
    """Call sites by the method they stand in, in order; brackets that match nothing do not matter here."""
    calls_ = spans.with_scope(java.scan_tokens(sources(t))).where("scope LIKE 'm%'").groupBy("path", "opened", "scope", "recv", F.col("name").alias("callee")).agg(F.min("pos").alias("pos"))
    return calls_.select("scope", "recv", "callee", (F.row_number().over(Window.partitionBy("path", "opened").orderBy("pos")) - 1).alias("rank"))


@query("call_rank", f"SELECT 'm' || s AS mth, call, CAST(rank AS INTEGER) AS rank FROM (SELECT s, unnest(['Svc' || t || '.Svc' || t || '()', 'Svc' || t || '.run' || u || '()', cls || '.local' || s || '()', 'Repo' || (k % 4) || '.find()', 'Repo' || (k % 4) || '.save()', cls || '.helper()', 'Ex' || u || '.Ex' || u || '()', 'Item.close()']) AS call, unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS rank FROM {_METHODS})")
def call_rank(t: Tables) -> DataFrame:
    """Order of a method's distinct calls, by first place; the chain form of a call has its root's place and does not count."""
    f = called(t).where("mth LIKE 'm%' AND type <> 'chain' AND NOT fallback").groupBy("path", "mth", F.col("name").alias("call")).agg(F.min("pos").alias("pos"))
    return f.select("mth", "call", (F.row_number().over(Window.partitionBy("path", "mth").orderBy("pos")) - 1).alias("rank"))


_CALL_ROWS = f"""SELECT k, {_PATH} AS path, s, unnest(range(9)) AS i, 'm' || s AS mth, unnest([NULL, 'v' || s, NULL, 'repo', NULL, 'repo', 'this', NULL, 'item']) AS recv, unnest(['svc' || t, 'run' || u, 'local' || s, 'find', 'next', 'save', 'helper', 'ex' || u, 'close']) AS callee FROM {_PARTS} JOIN {_UNITS} USING (k)
    UNION ALL SELECT k, {_PATH}, 1000000000, 0, 'over', NULL, 'shut' FROM {_UNITS}"""


@query("call_activations", f"SELECT 'unit' || k AS cls, mth, recv, callee, row_number() OVER (ORDER BY string_split(path, '/'), s, i) - 1 AS rank FROM ({_CALL_ROWS})")
def call_activations(t: Tables) -> DataFrame:
    """Calls of each opened body, in one count over all files in the order of a walk."""
    return spans.call_order(java.scan_tokens(sources(t))).select("cls", "mth", "recv", "callee", "rank")


@query("call_rank_anywhere", f"""WITH r AS (SELECT 'unit' || k AS cls, mth, recv, callee, row_number() OVER (ORDER BY string_split(path, '/'), s, i) - 1 AS rank FROM ({_CALL_ROWS})),
    c AS (SELECT p_partkey AS p, 'unit' || (p_partkey // 20) AS pcls, 'm' || (p_partkey + CASE WHEN p_partkey % 4 = 3 THEN 1000000 ELSE 0 END) AS pmth, CASE p_partkey % 3 WHEN 0 THEN 'repo' WHEN 1 THEN 'other' ELSE 'item' END AS cls, CASE p_partkey % 4 WHEN 0 THEN 'save' WHEN 1 THEN 'helper' WHEN 2 THEN 'shut' ELSE 'close' END AS mth FROM part)
    SELECT p, coalesce((SELECT min(rank) FROM r WHERE r.cls = c.pcls AND r.mth = c.pmth AND r.callee = c.mth AND (r.recv IS NULL OR r.recv = c.cls)), (SELECT min(rank) FROM r WHERE r.cls = c.pcls AND r.mth = c.pmth AND r.callee = c.mth), (SELECT min(rank) FROM r WHERE r.callee = c.mth), 1000000000) AS rank FROM c""")
def call_rank_anywhere(t: Tables) -> DataFrame:
    """Ranks of cells under their parents; where the parent is unknown, the first call of that name in all files."""
    p = F.col("p_partkey")
    cells = t.part.select(p.alias("p"), fill("unit«k»", k=F.floor(p / 20)).alias("pcls"), fill("m«s»", s=p + F.when(p % 4 == 3, 1000000).otherwise(0)).alias("pmth"), F.when(p % 3 == 0, "repo").when(p % 3 == 1, "other").otherwise("item").alias("cls"), F.when(p % 4 == 0, "save").when(p % 4 == 1, "helper").when(p % 4 == 2, "shut").otherwise("close").alias("mth"))
    return lookup.call_rank(cells, materialize(spans.call_order(java.scan_tokens(sources(t))))).select("p", "rank")


_LINES = f"""SELECT k, 'm' || s AS mth, {METHOD_LINES} AS block, {METHOD_LINES - 1} AS block_filled, {METHOD_LINES - 1} AS opened_filled, {METHOD_LINES} AS file_first, ['int', 'List', 'Svc' || t || '[]'] AS types FROM {_PARTS} JOIN {_UNITS} USING (k)
    UNION ALL SELECT k, unnest(['Unit' || k, 'helper', 'over', 'over', 'over', 'x', 'open', 'shut']), unnest([1, 1, 1, 3, 4, 1, 1, 1]), unnest([1, 1, 1, 3, 3, 1, 1, 1]), unnest([1, 1, 1, 3, 3, 1, 1, 1]), 1, unnest([['int'], [], ['int'], ['int', 'String'], ['String', 'long'], [], ['String'], []]) FROM {_UNITS}"""


@query("method_lines", f"SELECT cls, mth, array_to_string(types, ';') AS types, CAST(block AS INTEGER) AS block, CAST(block_filled AS INTEGER) AS block_filled, CAST(opened_filled AS INTEGER) AS opened_filled, CAST(file_first AS INTEGER) AS file_first FROM (SELECT 'Unit' || k AS cls, * FROM ({_LINES}) UNION ALL SELECT CASE WHEN mth = 'x' THEN 'Kind' ELSE 'Port' END, * FROM ({_LINES}) WHERE mth IN ('x', 'open', 'shut'))")
def method_lines(t: Tables) -> DataFrame:
    """Lines of declarations by four rules, from tokens with their partners. Files that do not parse count too."""
    files_ = materialize(sources(t))
    return spans.method_lines(files_, java.all_tokens(files_)).select("cls", "mth", F.array_join("types", ";").alias("types"), "block", "block_filled", "opened_filled", "file_first")


@query("overload_best", f"SELECT s, params, CAST(loc AS INTEGER) AS loc FROM (SELECT s, ['int;String', 'String;long', 'int', 'long;long', 'int;int;int'][s % 5 + 1] AS params, [3, 4, 1, 4, 4][s % 5 + 1] AS loc FROM {_METHODS})")
def overload_best(t: Tables) -> DataFrame:
    """Lines of the overload that a call means. Each method asks for over() of its class with some types."""
    found = kind(t, "method").where("mth = 'over'").select("cls", "mth", F.split(F.nullif("extra", F.lit("")), ";").alias("types"), (F.col("end") - F.col("line") + 1).alias("loc"))
    asked = F.array(*[F.lit(x) for x in ("int;String", "java.lang.String;long", "int", "long;long", "int;int;int")])
    s = F.col("p_partkey")
    want = t.part.select(s.alias("s"), fill("Unit«k»", k=F.floor(s / 20)).alias("cls"), F.lit("over").alias("mth"), F.get(asked, (s % 5).cast("int")).alias("asked")).withColumn("want", F.split("asked", ";"))
    return lookup.best_overload(want, found).select("s", F.replace("asked", F.lit("java.lang."), F.lit("")).alias("params"), "loc")


# --- properties ---------------------------------------------------------------------------------------------------------


def property_lines(t: Tables) -> DataFrame:
    """path, line_no, line: a file for each twenty parts, with comments, blanks and both separators."""
    k = F.col("p_partkey")
    r = F.floor(k / 20)
    lines = F.array(fill("# comment «k»", k=k), F.lit("  "), F.when(k % 2 == 0, fill("\tunit.k«k» = a=«r»\r", k=k, r=r)).otherwise(fill("unit.k«k»\t: v«r» \t", k=k, r=r)), fill("shared=r«r»\r", r=r), F.lit("\t! c=1\r"), F.lit("\r"))
    return t.part.select(fill("conf/r«r».properties", r=r).alias("path"), (k * 10).alias("base"), F.posexplode(lines).alias("i", "line")).select("path", (F.col("base") + F.col("i")).alias("line_no"), "line")


_SHARED = "(SELECT 'r' || max_by(p_partkey // 20, 'conf/r' || (p_partkey // 20) || '.properties') FROM part)"
_PROPS = f"(SELECT 'unit.k' || p_partkey AS key, CASE WHEN p_partkey % 2 = 0 THEN 'a=' || (p_partkey // 20) ELSE 'v' || (p_partkey // 20) END AS value FROM part UNION ALL SELECT 'shared', {_SHARED})"


@query("properties_scan", f"SELECT key, value FROM {_PROPS}")
def properties_scan(t: Tables) -> DataFrame:
    return S.properties(property_lines(t))


@query("properties_ref_lookup", "SELECT 'conf/r' || s_suppkey || '.properties' AS path, CASE WHEN s_suppkey % 2 = 0 THEN 'conf/r' || s_suppkey || '.properties' ELSE 'other/r' || s_suppkey || '.properties' END AS ref FROM supplier")
def properties_ref_lookup(t: Tables) -> DataFrame:
    r = F.col("s_suppkey")
    files_ = property_lines(t).select("path").distinct()
    refs = t.supplier.select(fill("«d»/r«r».properties", d=F.when(r % 2 == 0, F.lit("conf")).otherwise(F.lit("other")), r=r).alias("ref"))
    return S.refs_to_files(refs, files_).select("path", "ref")


@query("props_value", f"SELECT 'Unit' || k AS cls, 'prop' || k AS var, p.key, p.value FROM {_GOOD} JOIN {_PROPS} p ON p.key = 'unit.k' || k")
def props_value(t: Tables) -> DataFrame:
    refs = kind(t, "value").select("cls", F.col("type").alias("var"), F.col("name").alias("key"))
    return refs.join(S.properties(property_lines(t)), "key", "left").select("cls", "var", "key", F.coalesce("value", F.lit("NOT_FOUND")).alias("value"))


def config_text(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(k.alias("k"), fill('@ConfigurationProperties(prefix = "unit.k«k»") @PropertySource("classpath:conf/r«r».properties") class C«k» { String m«k»() { return messageSource.getMessage("shared"); } }', k=k, r=F.floor(k / 20)).alias("text"))


@query("props_prefix", f"SELECT p_partkey AS k, p.key, p.value FROM part JOIN {_PROPS} p ON p.key = 'unit.k' || p_partkey OR starts_with(p.key, 'unit.k' || p_partkey || '.')")
def props_prefix(t: Tables) -> DataFrame:
    own = config_text(t).select("k", F.regexp_extract("text", r'@ConfigurationProperties\(\s*(?:prefix\s*=\s*)?"([^"]+)"', 1).alias("prefix"))
    props = S.properties(property_lines(t))
    return lookup.prefix_join(props.select("key"), own.select("prefix").distinct()).join(own, "prefix").join(props, "key").select("k", "key", "value")


@query("props_source", "SELECT p_partkey AS k, 'conf/r' || (p_partkey // 20) || '.properties' AS path FROM part")
def props_source(t: Tables) -> DataFrame:
    refs = config_text(t).select("k", T.normalize_ref(F.regexp_extract("text", r'@PropertySource\(\s*"([^"]+)"', 1)).alias("ref"))
    found = S.refs_to_files(refs.select("ref").distinct(), property_lines(t).select("path").distinct())
    return refs.join(found, "ref").select("k", "path")


@query("props_message", f"SELECT p_partkey AS k, 'm' || p_partkey AS mth, {_SHARED} AS value FROM part")
def props_message(t: Tables) -> DataFrame:
    own = config_text(t).select("k", F.regexp_extract("text", r"String\s+(m[0-9]+)\(", 1).alias("mth"), F.regexp_extract("text", r'getMessage\(\s*"([^"]+)"', 1).alias("key"))
    return own.join(S.properties(property_lines(t)), "key", "left").select("k", "mth", F.coalesce("value", F.lit("NOT_FOUND")).alias("value"))


@query("props_with_method", "SELECT p_partkey AS k, 'm' || p_partkey AS mth FROM part WHERE p_partkey % 3 <> 0")
def props_with_method(t: Tables) -> DataFrame:
    """References outside of methods have none and go; the full table keeps them."""
    mth = F.nullif(F.regexp_extract("text", r"String\s+(m[0-9]+)\(", 1), F.lit(""))
    return config_text(t).select("k", F.when(F.col("k") % 3 != 0, mth).alias("mth")).where("mth IS NOT NULL")


# --- files, sinks, configuration ----------------------------------------------------------------------------------------


def _written(t: Tables) -> str:
    """The generated sources as files in the shared folder, by package, and once more in a build folder. The tree itself
    stands below a folder of such a name."""
    path = new_path(t.spark, "tree") + "/build/tree"
    out = sources(t).select("text", F.regexp_extract("path", "(r[0-9]+)/", 1).alias("dir"))
    out.repartition("dir").write.partitionBy("dir").option("lineSep", "\n//EOF\n").text(f"{path}/src")
    out.select("text").write.option("lineSep", "\n//EOF\n").text(f"{path}/target")
    return path


def _units(files_: DataFrame) -> DataFrame:
    """cls, methods of the sources in files."""
    one = files_.select(F.explode(F.split("text", "\n//EOF\n")).alias("text")).where(F.trim("text") != "")
    return one.select(F.regexp_extract("text", r"public class (\w+)", 1).alias("cls"), F.size(F.regexp_extract_all("text", F.lit(r"public (Svc\d) m\d+\("), F.lit(1))).alias("methods"))


@query("scan_files", f"SELECT cls, methods FROM (SELECT 'Unit' || k AS cls, CAST(count(*) AS INTEGER) AS methods FROM {_ALL_METHODS} GROUP BY k), range(2)")
def scan_files(t: Tables) -> DataFrame:
    """All files below the folder: each source stands there twice."""
    return _units(S.scan_files(t.spark, _written(t), ".txt"))


@query("scan_pruned_dirs", f"SELECT 'Unit' || k AS cls, CAST(count(*) AS INTEGER) AS methods FROM {_ALL_METHODS} GROUP BY k")
def scan_pruned_dirs(t: Tables) -> DataFrame:
    """The build folder's copies are gone."""
    return _units(S.scan_files(t.spark, _written(t), ".txt", pruned=True))


@query("scan_order", f"SELECT path, row_number() OVER (ORDER BY string_split(path, '/')) - 1 AS pos FROM (SELECT {_PATH} AS path FROM {_UNITS})")
def scan_order(t: Tables) -> DataFrame:
    """Folders and files in order, compared part by part."""
    return ordering.global_rank(sources(t).select("path", F.split("path", "/").alias("parts")), ["parts"], "pos").select("path", "pos")


@query("decode_lossy", "SELECT doc_id, md5(text || CASE WHEN doc_id % 2 = 0 THEN '(' || chr(65533) ELSE '(' END) AS digest FROM documents")
def decode_lossy(t: Tables) -> DataFrame:
    """Two bytes that are no UTF-8 behind each text go, the bracket between them stays, and so does a real U+FFFD."""
    raw = F.concat(F.encode("text", "UTF-8"), F.unhex(F.when(F.col("doc_id") % 2 == 0, F.lit("C328FFEFBFBDE282")).otherwise(F.lit("C328FF"))))
    return t.documents.select("doc_id", F.md5(S.decode_lossy(raw)).alias("digest"))


@query("reachable_sources", f"WITH RECURSIVE w AS (SELECT k, r, 0 AS depth FROM {_UNITS} WHERE k = 0 UNION ALL SELECT u.k, u.r, w.depth + 1 FROM w JOIN {_UNITS} u ON u.k IN (2 * w.k + 1, 2 * w.k + 2) WHERE w.k % 7 <> 6) SELECT 'Unit' || k || '.java' AS file_name, {_PATH} AS path, CAST(depth AS INTEGER) AS depth FROM w")
def reachable_sources(t: Tables) -> DataFrame:
    """Sources reached from Unit0 over imports are copied to a folder, under their full paths, so that equal names do not collide."""
    files_ = materialize(sources(t))
    f = materialize(java.parse_sources(files_).where("kind IN ('import', 'type')"))
    index = S.type_index(files_.select("path"), f.where("kind = 'type' AND type <> 'anonymous'").select("path", "cls"))
    refs = f.where("kind = 'import' AND type = 'type' AND NOT fallback").select(F.col("path").alias("src"), T.simple_type(F.col("name")).alias("key"))
    edges = refs.join(index.select("key", F.col("path").alias("dst")), "key").select("src", "dst")
    seen = graph.reachable(edges, index.where("key = 'Unit0'").select(F.col("path").alias("node")))
    copied = new_path(t.spark, "copied")
    seen.join(files_.withColumnRenamed("path", "node"), "node").select(F.regexp_replace("node", "^.*/", "").alias("file_name"), F.col("node").alias("path"), "depth", "text").write.parquet(copied)
    return t.spark.read.parquet(copied).where(F.length("text") > 0).select("file_name", "path", "depth")


@query("sink_overwrite", "SELECT cls, count(*) AS n FROM {nodes} GROUP BY 1")
def sink_overwrite(t: Tables) -> DataFrame:
    book = new_path(t.spark, "book")
    for _ in range(2):
        S.write_sheets(book, {"Methods": t.nodes, "Calls": t.edges})
    return S.read_sheet(t.spark, book, "Methods").groupBy("cls").agg(F.count("*").alias("n"))


@query("sink_append", "SELECT sheet, cls, count(*) AS n FROM {nodes}, (SELECT unnest(['Methods', 'Methods1', 'Methods2']) AS sheet) GROUP BY 1, 2")
def sink_append(t: Tables) -> DataFrame:
    """A sheet whose name is taken becomes a new one."""
    book = new_path(t.spark, "book")
    for _ in range(3):
        S.write_sheets(book, {"Methods": t.nodes}, "append")
    sheets = [S.read_sheet(t.spark, book, s).groupBy("cls").agg(F.count("*").alias("n")).select(F.lit(s).alias("sheet"), "cls", "n") for s in ("Methods", "Methods1", "Methods2")]
    return sheets[0].unionByName(sheets[1]).unionByName(sheets[2])


@query("sheet_scan_optional", "SELECT chunk, 'g' || (o_custkey % 3) AS rule, CAST(NULL AS VARCHAR) AS owner FROM (SELECT DISTINCT l_orderkey AS chunk FROM lineitem) LEFT JOIN orders ON o_orderkey = chunk AND o_orderkey % 2 = 0")
def sheet_scan_optional(t: Tables) -> DataFrame:
    """A sheet that is there joins; a missing one reads as an empty table, so the join keeps all chunks."""
    book = new_path(t.spark, "book")
    S.write_sheets(book, {"Rules": t.orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("chunk"), F.concat(F.lit("g"), s_(F.col("o_custkey") % 3)).alias("rule"))})
    rules = S.read_sheet_or_empty(t.spark, book, "Rules", "chunk BIGINT, rule STRING")
    owners = S.read_sheet_or_empty(t.spark, book, "Owners", "chunk BIGINT, owner STRING")
    return t.tokens.select("chunk").distinct().join(rules, "chunk", "left").join(owners, "chunk", "left").select("chunk", "rule", "owner")


@query("require_columns", "SELECT parent, child, entity FROM {chunk_edges}")
def require_columns(t: Tables) -> DataFrame:
    return S.require_columns(t.chunk_edges, ["parent", "child", "entity"])


@query("trim_columns", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def trim_columns(t: Tables) -> DataFrame:
    return S.trim_columns(t.customer.withColumnsRenamed({"c_name": " c_name ", "c_acctbal": "c_acctbal "}))


#: A configuration as it stands in a file: patterns with entities, and lists that replace the defaults.
CONFIG = """{"Language": {"Java": {"Application": {"shop": {
  "Language_details": {"Extension": ".java", "control_keywords": ["the", "of", "and"], "SYSTEM_METHODS": ["get", "in"], "COLLECTION_TYPES": ["List", "Map", "Deque"]},
  "Regex_Pattern": {"package": "(?m)^\\\\s*package\\\\s+([\\\\w.]+)\\\\s*;", "call": "\\\\b([A-Za-z_]\\\\w*)\\\\s*\\\\.\\\\s*([A-Za-z_]\\\\w*)\\\\s*\\\\(", "map": "\\\\bMap&lt;(?P&lt;key&gt;\\\\w+)"}}}}}}"""


def _config(t: Tables) -> settings.Config:
    path = new_path(t.spark, "config")
    t.region.where("r_regionkey = 0").select(F.lit(CONFIG).alias("value")).coalesce(1).write.text(path)
    return settings.read_config(t.spark, path, "Java", "shop")


_CALL_RE = r"\b([A-Za-z_]\w*)\s*\.\s*([A-Za-z_]\w*)\s*\("


@query("regex_registry", f"SELECT {_PATH} AS path, CAST(1 AS INTEGER) AS package, CAST((SELECT count(*) FROM {_PARTS} p WHERE p.k = u.k) * {len(re.findall(_CALL_RE, METHOD.replace('«', '').replace('»', '')))} + {len(re.findall(_CALL_RE, CLASS))} AS INTEGER) AS call, CAST(1 AS INTEGER) AS map FROM {_UNITS} u")
def regex_registry(t: Tables) -> DataFrame:
    """Matches of the configured patterns; a name that the configuration lacks is an error where it is asked for."""
    config = _config(t)
    return sources(t).select("path", *[F.size(F.regexp_extract_all("text", F.lit(config.pattern(n)), F.lit(0))).alias(n) for n in ("package", "call", "map")])


_LIST_WORDS = {"control": ("the", "of", "and"), "system": ("get", "in")}


@query("word_lists", f"SELECT CASE WHEN w IN {_LIST_WORDS['control']} THEN 'control_keywords' WHEN w IN {_LIST_WORDS['system']} THEN 'SYSTEM_METHODS' WHEN w IN ('int', 'long', 'short', 'byte', 'char', 'float', 'double', 'boolean', 'void') THEN 'PRIMITIVE' WHEN w IN ('list', 'map', 'deque') THEN 'COLLECTION_TYPES' ELSE 'other' END AS list, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS w FROM documents) GROUP BY 1")
def word_lists(t: Tables) -> DataFrame:
    """Words of the texts by the first configured list that has them; a list that the configuration lacks has its default."""
    config = _config(t)
    words = t.documents.select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w"))
    found = F.lit("other")
    for name in ("COLLECTION_TYPES", "PRIMITIVE", "SYSTEM_METHODS", "control_keywords"):
        found = F.when(F.col("w").isin(*[x.lower() for x in config.words(name)]), name).otherwise(found)
    return words.select(found.alias("list")).groupBy("list").agg(F.count("*").alias("n"))


@query("adapter_spi", r"SELECT 'page' || page_id AS path, unnest(regexp_extract_all(html, '([a-z]+)\([0-9]+\)', 1)) || '()' AS call FROM pages UNION ALL SELECT 'P' || p_partkey || '.java', 'B' || (p_partkey % 3) || '.go()' FROM part")
def adapter_spi(t: Tables) -> DataFrame:
    """Two languages over one table of files: each file goes to the adapter of its language, which the executors look up by name."""
    p = F.col("p_partkey")
    pages = t.pages.select(fill("page«k»", k=F.col("page_id")).alias("path"), F.col("html").alias("text"), F.lit("script").alias("language"))
    java_ = t.part.select(fill("P«p».java", p=p).alias("path"), fill("class P«p» { B«q» b; void m() { b.go(); } }", p=p, q=p % 3).alias("text"), F.lit("java").alias("language"))
    return resolution.resolved_calls(materialize(adapters.parse(pages.unionByName(java_), "language"))).select("path", F.col("name").alias("call"))
