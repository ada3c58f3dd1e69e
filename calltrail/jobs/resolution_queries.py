"""Queries over calls that are resolved by joins. Each row of a table takes the part of one case, by its key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.jobs.fixtures import Tables
from calltrail.jobs.parser_queries import blank, fill, property_lines, sources
from calltrail.jobs.registry import query
from calltrail.operators import resolution
from calltrail.sources.projects import open_project

#: A method's statements by case, each with what its chains give: roots that are variables, fields, types, constructors
#: and unknown; keywords; names that are claimed, and names that a qualified call has already.
_CHAINS = {
    0: ("v.find(a«p»).next(1);", [("Svc«t».find(a«p»).next(1)", "rewritten")]),
    1: ("repo.load(x).go().stop();", [("Repo«q».load(x).go().stop()", "rewritten"), ("go()", "dynamic"), ("stop()", "dynamic")]),
    2: ("return new Big«t»(a).times(b).plus(c);", [("Big«t».times()", "ctor"), ("Big«t».plus()", "ctor")]),
    3: ("unknown«p».call(a).then();", [("then()", "dynamic")]),
    4: ("Util«t».make(a).then(b);", [("Util«t».make(a).then(b)", "class"), ("then()", "dynamic")]),
    5: ("this.go(a).then(); super.end();", [("then()", "dynamic")]),
    6: ("v.go(/* no.way(a).out() */ \"q.r(s).t(u)\"); ((Cast) c).open().shut(); new Big«t»(a).shut(); f(x).shut();", [("Svc«t».go(   )", "rewritten"), ("Big«t».shut()", "ctor"), ("open.shut()", "ctor"), ("f.shut()", "ctor")]),
    7: ("v . spaced(a); field«t».v.deep(b);", [("Svc«t».deep(b)", "rewritten")]),
}


def _case(values: dict[int, str]) -> str:
    return " ".join(f"WHEN {k} THEN {v}" for k, v in values.items())


def _sql(text: str) -> str:
    quoted = text.replace("'", "''")
    for name in "ptq":
        quoted = quoted.replace(f"«{name}»", f"' || {name} || '")
    return f"'{quoted}'"


_ROWS = " UNION ALL ".join(f"SELECT p AS body, {_sql(call)} AS call, '{how}' AS how FROM b WHERE p % 8 = {k}" for k, (_, rows) in _CHAINS.items() for call, how in rows)


@query("chain_claims", f"WITH b AS (SELECT p_partkey AS p, p_partkey % 5 AS t, p_partkey % 3 AS q FROM part) {_ROWS}")
def chain_claims(t: Tables) -> DataFrame:
    """Chains of all bodies, and bare names that nothing claims. Variables hide nothing: a field of the class goes first."""
    p = F.col("p_partkey")
    text = F.lit(None)
    for k, (body, _) in _CHAINS.items():
        text = F.when(p % 8 == k, fill(body, p=p, t=p % 5, q=p % 3)).otherwise(text)
    rows = t.part.select(p.alias("body"), fill("C«q»", q=p % 3).alias("cls"), (p % 8).alias("k"), fill("Svc«t»<Item>", t=p % 5).alias("type"), text.alias("raw"))
    bodies = rows.select("body", "cls", blank(F.col("raw"), True, " ").alias("source"))
    variables = rows.select("body", F.explode(F.array(F.lit("v"), F.lit("repo"))).alias("name"), "type")
    fields = t.part.select((p % 3).alias("q")).distinct().select(fill("C«q»", q=F.col("q")).alias("cls"), F.lit("repo").alias("name"), fill("Repo«q»", q=F.col("q")).alias("type"))
    qualified = rows.where("k IN (0, 5)").select("body", F.explode(F.when(F.col("k") == 0, F.array(F.lit("find"), F.lit("next"))).otherwise(F.array(F.lit("end")))).alias("mth"))
    return resolution.chain_calls(bodies, variables, fields, qualified)


#: Root, member and rule by case; «n» marks a part's own names.
_KEPT = [
    ("fld", "m", "field"), ("made", "m", "local_new"), ("arg", "m", "parameter"), ("known", "m", "imported_type"), ("Lib", "m", "imported_root"), ("wild", "m", "wildcard"),
    ("argarg", "m", "parameter"), ("nothing", "m", None), (None, "MAX", "static_member"), (None, "other", None),
]


@query(
    "keep_calls",
    f"""WITH c AS (SELECT p_partkey AS body, p_partkey % 4 AS app, CASE p_partkey % 10 {_case({k: f"'{r[0]}'" if r[0] else 'NULL' for k, r in enumerate(_KEPT)})} END AS root, CASE p_partkey % 10 {_case({k: f"'{r[2]}'" if r[2] else 'NULL' for k, r in enumerate(_KEPT)})} END AS rule FROM part)
    SELECT body, root, CASE WHEN root IS NULL AND app = 1 THEN 'include_unqualified' WHEN root IS NULL THEN coalesce(rule, CASE WHEN body % 3 = 0 THEN 'static_wildcard' END)
        WHEN rule IS NULL OR rule IN ('field', 'imported_type', 'imported_root') OR (app = 1 AND rule IN ('local_new', 'parameter')) THEN rule
        WHEN body % 3 <> 2 THEN 'wildcard' WHEN app IN (1, 2) AND body % 7 <> 0 THEN 'same_package' ELSE 'typed' END AS kept_by FROM c""",
)
def keep_calls(t: Tables) -> DataFrame:
    """Calls of ten kinds in applications with all flags (1), the package flag alone (2), none (0), and no row (3)."""
    p = F.col("p_partkey")
    path = fill("F«p».java", p=p)
    pick = lambda k: F.get(F.array(*[F.lit(r[k]) for r in _KEPT]), (p % 10).cast("int"))
    calls = t.part.select((p % 4).alias("application"), path.alias("path"), F.lit("C").alias("cls"), p.alias("body"), pick(0).alias("root"), pick(1).alias("mth"))
    names = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(ty).alias("type"), F.lit(h).alias("how")) for n, ty, h in (("made", "Made", "new"), ("arg", "Arg", "param"), ("known", "Known<Item>", "local"), ("wild", "Wild", "local"))])
    variables = t.part.select(p.alias("body"), F.inline(names))
    fields = t.region.where("r_regionkey = 0").select(F.lit("C").alias("cls"), F.lit("fld").alias("name"))
    found = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(ty).alias("type")) for n, ty in (("com.a.Known", "type"), ("com.a.Lib", "type"), ("org.b.Nothing", "type"), ("com.a.Consts.MAX", "static"))])
    more = F.when(p % 3 == 0, F.array(F.struct(F.lit("com.w").alias("name"), F.lit("wildcard").alias("type")), F.struct(F.lit("com.w.All").alias("name"), F.lit("static_wildcard").alias("type")))).when(p % 3 == 1, F.array(F.struct(F.lit("com.w").alias("name"), F.lit("wildcard").alias("type")))).otherwise(F.array(F.struct(F.lit("org.w").alias("name"), F.lit("wildcard").alias("type"))))
    imports = t.part.select(path.alias("path"), F.inline(F.concat(found, more)))
    packages = t.part.select(path.alias("path"), F.when(p % 7 != 0, F.lit("com.app")).otherwise(F.lit("org.app")).alias("package"))
    on, off = F.lit(True), F.lit(False)
    flags = t.region.where("r_regionkey < 3").select(F.col("r_regionkey").cast("long").alias("application"), *[F.when(F.col("r_regionkey") == 1, on).when((F.col("r_regionkey") == 2) & F.lit(f == "accept_same_package"), on).otherwise(off).alias(f) for f in ("include_unqualified", "accept_local_new_types", "accept_parameter_types", "accept_same_package")])
    return resolution.keep_calls(calls, variables, fields, resolution.import_index(imports), packages, flags).select("body", "root", "kept_by")


#: Paths of one to six tokens before the method: variables of the file or of any, methods of the class so far, and unknown.
_PATH_SQL = "array_to_string(list_transform(range(1, 2 + p % 6), lambda k: CASE (p // 7 + k * (p % 4)) % 5 WHEN 0 THEN 'svc' || ((p + k) % 5) WHEN 1 THEN 'unknown' || k ELSE 'm' || ((p + 3 * k) % 11) END) || ['end'], '.')"


@query(
    "field_chain_fold",
    f"""WITH RECURSIVE scoped AS (SELECT file_name, var, min_by(type, (type LIKE 'List%', pos)) AS vt FROM {{var_types}} GROUP BY 1, 2), anywhere AS (SELECT var, min_by(type, (type LIKE 'List%', pos)) AS vt FROM {{var_types}} GROUP BY 1),
        r AS (SELECT cls, method, max_by(ret, pos) AS ret FROM {{returns}} GROUP BY 1, 2), c AS (SELECT p_partkey AS p, 'File' || (p_partkey % 7) || '.java' AS file_name FROM part),
        k AS (SELECT p AS id, file_name, string_split({_PATH_SQL}, '.') AS w FROM c),
        one AS (SELECT k.id, k.file_name, k.w, coalesce(regexp_replace((SELECT vt FROM scoped s WHERE s.file_name = k.file_name AND s.var = w[1]), '<[^>]+>', ''), regexp_replace((SELECT vt FROM anywhere a WHERE a.var = w[1]), '<[^>]+>', ''), CASE WHEN upper(left(w[1], 1)) || substr(w[1], 2) IN (SELECT cls FROM {{returns}}) THEN upper(left(w[1], 1)) || substr(w[1], 2) END, w[1]) AS cls FROM k),
        g AS (SELECT id, 1 AS i, file_name, w, cls FROM one UNION ALL SELECT g.id, g.i + 1, g.file_name, g.w, coalesce(regexp_replace(s.vt, '<[^>]+>', ''), regexp_replace(a.vt, '<[^>]+>', ''), CASE WHEN r.ret <> 'void' THEN string_split(r.ret, '.')[-1] END, g.cls)
            FROM g LEFT JOIN scoped s ON s.file_name = g.file_name AND s.var = g.w[g.i + 1] LEFT JOIN anywhere a ON a.var = g.w[g.i + 1] LEFT JOIN r ON r.cls = g.cls AND r.method = g.w[g.i + 1] WHERE g.i + 1 < len(g.w))
        SELECT id, cls, w[-1] AS mth FROM g WHERE i = len(w) - 1""",
)
def field_chain_fold(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    token = F.transform(
        F.sequence(F.lit(1).cast("long"), 1 + p % 6),
        lambda k: F.when((F.floor(p / 7) + k * (p % 4)) % 5 == 0, fill("svc«n»", n=(p + k) % 5)).when((F.floor(p / 7) + k * (p % 4)) % 5 == 1, fill("unknown«k»", k=k)).otherwise(fill("m«n»", n=(p + 3 * k) % 11)),
    )
    chains = t.part.select(p.alias("id"), fill("File«n».java", n=p % 7).alias("file_name"), F.lit("Own").alias("class_interface_name"), F.array_join(F.concat(token, F.array(F.lit("end"))), ".").alias("path"))
    return resolution.fold_chains(chains, t.var_types, t.returns.select("cls"), t.returns)


@query(
    "project_tables",
    r"""WITH u AS (SELECT count(*) AS u, count(*) FILTER (s_suppkey % 7 = 6) AS bad FROM supplier), m AS (SELECT count(*) AS p, count(DISTINCT p_partkey // 20) AS own FROM part WHERE p_partkey // 20 IN (SELECT s_suppkey FROM supplier)),
    g AS (SELECT count(*) AS calls FROM pages, unnest(regexp_extract_all(html, '([a-z]+)\([0-9]+\)', 1)))
    SELECT unnest(['declared_types', 'methods', 'metadata', 'calls', 'kept calls', 'fallback', 'variable_types', 'return_index', 'parents', 'type_index', 'method_lines', 'properties', 'keywords', 'script calls', 'script types']) AS what,
        unnest([3 * u, p + 7 * u, p + 7 * u, 9 * p + u, 9 * p + u, bad, 6 * u + 2 * own + 2 * p, p + 3 * u + 2, u, u + 2, p + 11 * u, (SELECT count(*) + 1 FROM part), 12, g.calls, 0]) AS n FROM u, m, g""",
)
def project_tables(t: Tables) -> DataFrame:
    """Rows of every table that a language provides, for two languages."""
    java, script = open_project("java", sources(t)), open_project("script", t.pages.select(fill("page«k»", k=F.col("page_id")).alias("path"), F.col("html").alias("text")))
    calls = java.calls()
    tables = {name: getattr(java, name)() for name in ("declared_types", "methods", "metadata", "fallback", "variable_types", "return_index", "parents", "type_index", "method_lines")}
    tables |= {"calls": calls, "kept calls": calls.where("kept_by IS NOT NULL"), "properties": java.properties(property_lines(t)), "script calls": script.calls(), "script types": script.declared_types()}
    tables["keywords"] = t.spark.createDataFrame([(w,) for w in java.keywords()], "w STRING").join(t.region.where("r_regionkey = 0"))
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n") for name, df in tables.items()])
