"""Queries over lookups, aggregates, windows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.jobs.fixtures import Tables
from calltrail.jobs.registry import query
from calltrail.jobs.scalar_queries import _SQL_METHODS, KEY
from calltrail.operators import lookup, ordering
from calltrail.operators.shared import materialize

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "loc"]
_O = "(l_orderkey, l_linenumber, l_partkey, l_suppkey, loc)"
CLASS_KEY = ["class_interface_name", "method_name", "parameters"]
#: Owners and chain steps as SQL, for checks.
_WALK = """
    up AS (SELECT 'Svc' || i AS cls, 'Svc' || i AS anc, 0 AS d, ['Svc' || i] AS seen FROM range(5) t(i)
           UNION ALL SELECT u.cls, p.parent, u.d + 1, list_append(u.seen, p.parent) FROM up u JOIN {parents} p ON p.cls = u.anc WHERE NOT list_contains(u.seen, p.parent)),
    own AS (SELECT up.cls, r.method, min_by(up.anc, up.d) AS owner FROM up JOIN (SELECT DISTINCT cls, method FROM {returns}) r ON r.cls = up.anc GROUP BY 1, 2),
    ret AS (SELECT cls, method, max_by(ret, pos) AS ret FROM {returns} GROUP BY 1, 2),
    steps AS (SELECT own.cls, own.method, own.owner, CASE WHEN ret.ret <> 'void' THEN split_part(ret.ret, '.', -1) END AS next FROM own LEFT JOIN ret ON ret.cls = own.owner AND ret.method = own.method)"""
_CHAINS = "(SELECT p_partkey AS id, 'Svc' || (p_partkey % 5) AS cls, ['m' || (p_partkey % 11), 'm' || ((p_partkey * 3) % 11), 'm' || ((p_partkey * 7) % 11)] AS methods FROM part)"
_CHAIN_WALK = f"""walk AS (SELECT c.id, c.methods, 0 AS pos, coalesce(s.owner, c.cls) AS owner, c.methods[1] AS method, s.next AS next FROM {_CHAINS} c LEFT JOIN steps s ON s.cls = c.cls AND s.method = c.methods[1]
    UNION ALL SELECT w.id, w.methods, w.pos + 1, coalesce(s.owner, w.next), w.methods[w.pos + 2], s.next FROM walk w LEFT JOIN steps s ON s.cls = w.next AND s.method = w.methods[w.pos + 2] WHERE w.next IS NOT NULL AND w.pos + 1 < 3)"""


def chains(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    name = lambda k: F.concat(F.lit("m"), ((p * k) % 11).cast("string"))
    return t.part.select(p.alias("id"), F.concat(F.lit("Svc"), (p % 5).cast("string")).alias("cls"), F.array(name(1), name(3), name(7)).alias("methods"))


def classes(t: Tables) -> DataFrame:
    return t.calls.select(F.col("class_interface_name").alias("cls")).distinct()


def calls_of(t: Tables) -> DataFrame:
    """Calls with their base and method."""
    call = F.col("object_call")
    return t.calls.withColumn("base", T.call_base(call)).withColumn("called", F.nullif(F.regexp_extract(F.substring_index(call, "(", 1), r"([A-Za-z_][A-Za-z0-9_]*)$", 1), F.lit("")))


# --- aggregates and dedup ---------------------------------------------------------------------------------------------


@query("array_dedup", "SELECT chunk, string_agg(token, '|' ORDER BY f) AS tokens FROM (SELECT chunk, token, min((line, part, supp, quantity, price)) AS f FROM {tokens} GROUP BY 1, 2) GROUP BY 1")
def array_dedup(t: Tables) -> DataFrame:
    order = ["line", "part", "supp", "quantity", "price"]
    return t.tokens.groupBy("chunk").agg(F.array_join(F.array_distinct(ordering.ordered_list("token", order)), "|").alias("tokens"))


@query("callee_sets", "SELECT class_interface_name, method_name, string_agg(DISTINCT object_call, '|' ORDER BY object_call) AS callees FROM {calls} WHERE lower(object_call) NOT IN ('', 'none', 'null', 'na') GROUP BY 1, 2")
def callee_sets(t: Tables) -> DataFrame:
    return t.calls.where(~T.is_sentinel(F.col("object_call"))).groupBy("class_interface_name", "method_name").agg(F.array_join(F.array_sort(F.collect_set("object_call")), "|").alias("callees"))


@query("unique_parent", f"SELECT class_interface_name, method_name, parameters, min_by(annotations, {_O}) FILTER (annotations IS NOT NULL) AS annotations, min_by(object_call, {_O}) FILTER (object_call IS NOT NULL) AS object_call, min_by(access, {_O}) AS access FROM {{calls}} WHERE parameters IS NOT NULL GROUP BY 1, 2, 3")
def unique_parent(t: Tables) -> DataFrame:
    return ordering.first_non_null(t.calls, CLASS_KEY, ["annotations", "object_call", "access"], ORDER)


@query("distinct_rows", "SELECT DISTINCT file_name, class_interface_name, method_name, object_call FROM {calls}")
def distinct_rows(t: Tables) -> DataFrame:
    return t.calls.select("file_name", "class_interface_name", "method_name", "object_call").distinct()


@query("dedup_first", f"SELECT class_interface_name, method_name, parameters, min_by(l_orderkey, {_O}) AS l_orderkey FROM {{calls}} GROUP BY 1, 2, 3")
def dedup_first(t: Tables) -> DataFrame:
    return ordering.keep_first(t.calls.select(*CLASS_KEY, *ORDER), CLASS_KEY, ORDER).select(*CLASS_KEY, "l_orderkey")


@query("first_row", f"SELECT lower(class_interface_name) AS cls, lower(method_name) AS mth, min_by(type, {_O}) AS type, count(*) AS n FROM {{calls}} GROUP BY 1, 2")
def first_row(t: Tables) -> DataFrame:
    return t.calls.groupBy(F.lower("class_interface_name").alias("cls"), F.lower("method_name").alias("mth")).agg(F.min_by("type", F.struct(*ORDER)).alias("type"), F.count("*").alias("n"))


@query("last_wins", "SELECT cls, method, max_by(ret, pos) AS ret FROM {returns} GROUP BY 1, 2")
def last_wins(t: Tables) -> DataFrame:
    return lookup.return_types(t.returns)


@query("priority_upsert", "SELECT file_name, var, min_by(type, (type LIKE 'List%', pos)) AS var_type FROM {var_types} GROUP BY 1, 2")
def priority_upsert(t: Tables) -> DataFrame:
    return lookup.variable_types(t.var_types, ["file_name", "var"])


@query("chunk_method_max", "SELECT chunk, trim(split_part(token, ' no_of_lines', 1)) AS name, max(coalesce(try_cast(trim(split_part(token, ':', 2)) AS BIGINT), 0)) AS loc FROM {tokens} WHERE NOT regexp_matches(token, '^C[0-9]{3}_.+') GROUP BY 1, 2")
def chunk_method_max(t: Tables) -> DataFrame:
    parsed = t.tokens.select("chunk", T.parse_token(F.col("token")).alias("t")).where("t.kind = 'method'")
    return parsed.groupBy("chunk", F.col("t.name").alias("name")).agg(F.max("t.loc").alias("loc"))


@query("counts", "SELECT file_name, count(*) AS calls, count(DISTINCT class_interface_name) AS classes, count(DISTINCT method_name) AS methods, count(*) FILTER (object_call IS NULL) AS missing FROM {calls} GROUP BY 1")
def counts(t: Tables) -> DataFrame:
    return t.calls.groupBy("file_name").agg(F.count("*").alias("calls"), F.countDistinct("class_interface_name").alias("classes"), F.countDistinct("method_name").alias("methods"), F.count_if(F.col("object_call").isNull()).alias("missing"))


@query("string_agg", "SELECT chunk, string_agg(token, ', ' ORDER BY line, part, supp, quantity, price) AS tokens FROM {tokens} GROUP BY 1")
def string_agg(t: Tables) -> DataFrame:
    return t.tokens.groupBy("chunk").agg(F.array_join(ordering.ordered_list("token", ["line", "part", "supp", "quantity", "price"]), ", ").alias("tokens"))


@query("distinct_cells", "SELECT DISTINCT lower(c) AS cell FROM (SELECT unnest([l1, l2, l3, l4]) AS c FROM {paths}) WHERE c IS NOT NULL AND lower(c) NOT IN ('none', 'nan', 'na')")
def distinct_cells(t: Tables) -> DataFrame:
    cells = ordering.unpivot(t.paths, ["id"], ["l1", "l2", "l3", "l4"]).select(F.lower("cell").alias("cell"))
    return cells.where(F.col("cell").isNotNull() & ~F.col("cell").isin("none", "nan", "na")).distinct()


@query("col_width", "SELECT 'l' || k AS col, CAST(max(length(c)) AS INTEGER) AS width FROM (SELECT unnest([1, 2, 3, 4]) AS k, unnest([l1, l2, l3, l4]) AS c FROM {paths}) GROUP BY 1")
def col_width(t: Tables) -> DataFrame:
    return ordering.unpivot(t.paths, ["id"], ["l1", "l2", "l3", "l4"]).groupBy(F.concat(F.lit("l"), F.col("level").cast("string")).alias("col")).agg(F.max(F.length("cell")).alias("width"))


@query("max_depth", "SELECT l1, CAST(max(CASE WHEN l4 IS NULL THEN 3 ELSE 4 END) AS INTEGER) AS depth FROM {paths} GROUP BY 1")
def max_depth(t: Tables) -> DataFrame:
    return t.paths.groupBy("l1").agg(F.max(F.size(F.array_compact(F.array("l1", "l2", "l3", "l4")))).alias("depth"))


# --- lookups ----------------------------------------------------------------------------------------------------------

_TYPES = """scoped AS (SELECT file_name, var, min_by(type, (type LIKE 'List%', pos)) AS vt FROM {var_types} GROUP BY 1, 2),
    anywhere AS (SELECT var, min_by(type, (type LIKE 'List%', pos)) AS vt FROM {var_types} GROUP BY 1)"""
_RESOLVED = r"""CASE WHEN base IS NULL OR lower(base) IN ('this', 'super', 'return', 'new') THEN class_interface_name
    ELSE coalesce(regexp_replace(s.vt, '<[^>]+>', ''), regexp_replace(a.vt, '<[^>]+>', ''), CASE WHEN upper(left(base, 1)) || substr(base, 2) IN (SELECT class_interface_name FROM {calls}) THEN upper(left(base, 1)) || substr(base, 2) END, base) END"""
_BASE = r"nullif(regexp_extract(object_call, '^\s*([A-Za-z_][A-Za-z0-9_]*)\s*\.', 1), '')"
_CALLED = r"nullif(regexp_extract(split_part(object_call, '(', 1), '([A-Za-z_][A-Za-z0-9_]*)$', 1), '')"


@query("lookup_type", f"WITH {_TYPES}, c AS (SELECT *, {_BASE} AS base FROM {{calls}}) SELECT l_orderkey, l_linenumber, {_RESOLVED} AS resolved FROM c LEFT JOIN scoped s ON s.file_name = c.file_name AND s.var = lower(base) LEFT JOIN anywhere a ON a.var = lower(base)")
def lookup_type(t: Tables) -> DataFrame:
    return lookup.lookup_type(calls_of(t), F.col("base"), t.var_types, classes(t)).select(*KEY, "resolved")


@query(
    "map_call",
    f"""WITH RECURSIVE {_TYPES}, {_WALK}, c AS (SELECT *, {_BASE} AS base, {_CALLED} AS called FROM {{calls}}),
        r AS (SELECT c.*, {_RESOLVED} AS resolved FROM c LEFT JOIN scoped s ON s.file_name = c.file_name AND s.var = lower(base) LEFT JOIN anywhere a ON a.var = lower(base))
        SELECT l_orderkey, l_linenumber, CASE WHEN base IS NULL THEN object_call ELSE coalesce(own.owner, resolved) || '.' || called END AS mapped FROM r LEFT JOIN own ON own.cls = resolved AND own.method = called""",
)
def map_call(t: Tables) -> DataFrame:
    resolved = lookup.lookup_type(calls_of(t), F.col("base"), t.var_types, classes(t))
    owned = lookup.inherited_owner(resolved, "resolved", "called", t.returns, t.parents)
    return owned.select(*KEY, F.when(F.col("base").isNull(), F.col("object_call")).otherwise(F.concat_ws(".", "owner", "called")).alias("mapped"))


@query("inherit_owner", f"WITH RECURSIVE {_WALK} SELECT l_orderkey, l_linenumber, coalesce(own.owner, class_interface_name) AS owner FROM {{calls}} c LEFT JOIN own ON own.cls = class_interface_name AND own.method = method_name")
def inherit_owner(t: Tables) -> DataFrame:
    return lookup.inherited_owner(t.calls, "class_interface_name", "method_name", t.returns, t.parents).select(*KEY, "owner")


@query("return_type_lookup", "SELECT l_orderkey, l_linenumber, r.ret FROM {calls} c LEFT JOIN (SELECT cls, method, max_by(ret, pos) AS ret FROM {returns} GROUP BY 1, 2) r ON r.cls = class_interface_name AND r.method = method_name")
def return_type_lookup(t: Tables) -> DataFrame:
    ret = lookup.return_types(t.returns).withColumnsRenamed({"cls": "class_interface_name", "method": "method_name"})
    return t.calls.join(ret, ["class_interface_name", "method_name"], "left").select(*KEY, "ret")


@query("impl_substitute", """WITH m AS (SELECT 'Svc' || (p_partkey % 9) AS cls FROM part WHERE p_partkey % 9 NOT IN (1, 3, 7) UNION SELECT 'Svc' || (p_partkey % 9) || 'Impl' FROM part WHERE p_partkey % 9 < 6)
    SELECT s_suppkey, CASE WHEN cls || 'Impl' IN (SELECT cls FROM m) AND cls NOT IN (SELECT cls FROM m) THEN cls || 'Impl' ELSE cls END AS target FROM (SELECT s_suppkey, 'Svc' || (s_suppkey % 9) AS cls FROM supplier)""")
def impl_substitute(t: Tables) -> DataFrame:
    """An interface gives way to its implementation where that declares methods and the interface declares none."""
    svc = lambda c: F.concat(F.lit("Svc"), (c % 9).cast("string"))
    p = F.col("p_partkey")
    methods = t.part.where((p % 9).isin(1, 3, 7) == F.lit(False)).select(svc(p).alias("cls")).union(t.part.where(p % 9 < 6).select(F.concat(svc(p), F.lit("Impl"))))
    return lookup.substitute_impl(t.supplier.select("s_suppkey", svc(F.col("s_suppkey")).alias("cls")), "cls", methods).select("s_suppkey", F.col("target").alias("target"))


@query("flow_impl_redirect", "SELECT e.src, e.dst, n.cls || CASE WHEN n.id % 3 = 0 THEN 'Impl' ELSE '' END AS cls FROM {edges} e JOIN {nodes} n ON n.id = e.dst")
def flow_impl_redirect(t: Tables) -> DataFrame:
    rows = t.nodes.where("id % 3 = 0").select(F.lower(F.concat("cls", F.lit("Impl"))).alias("k"), F.lower("mth").alias("m"), F.concat("cls", F.lit("Impl")).alias("impl"))
    called = t.edges.join(t.nodes, F.col("id") == F.col("dst")).withColumn("k", F.lower(F.concat("cls", F.lit("Impl")))).withColumn("m", F.lower("mth"))
    return called.join(rows, ["k", "m"], "left").select("src", "dst", F.coalesce("impl", "cls").alias("cls"))


@query("chain_segments", f"WITH RECURSIVE {_WALK}, {_CHAIN_WALK} SELECT id, pos, owner || '.' || method || '()' AS segment FROM walk")
def chain_segments(t: Tables) -> DataFrame:
    c = chains(t)
    return lookup.chain_segments(c, lookup.chain_steps(t.returns, t.parents))


@query("chain_render", f"WITH RECURSIVE {_WALK}, {_CHAIN_WALK} SELECT id, string_agg(owner || '.' || method || '()', '.' ORDER BY pos) AS rendered FROM walk GROUP BY 1")
def chain_render(t: Tables) -> DataFrame:
    return chain_segments(t).groupBy("id").agg(F.array_join(ordering.ordered_list("segment", ["pos"]), ".").alias("rendered"))


@query(
    "field_chain",
    f"""WITH {_TYPES}, tok AS (SELECT s_suppkey AS id, 'File' || (s_suppkey % 7) || '.java' AS file_name, 'svc' || (s_suppkey % 5) AS a, 'svc' || ((s_suppkey + s_nationkey) % 9) AS b FROM supplier)
        SELECT id, coalesce(regexp_replace(s2.vt, '<[^>]+>', ''), regexp_replace(a2.vt, '<[^>]+>', ''), regexp_replace(s1.vt, '<[^>]+>', ''), regexp_replace(a1.vt, '<[^>]+>', ''), a) AS cls FROM tok
        LEFT JOIN scoped s1 ON s1.file_name = tok.file_name AND s1.var = a LEFT JOIN anywhere a1 ON a1.var = a
        LEFT JOIN scoped s2 ON s2.file_name = tok.file_name AND s2.var = b LEFT JOIN anywhere a2 ON a2.var = b""",
)
def field_chain(t: Tables) -> DataFrame:
    """a.b.m(): the class after the last token that has a type; a token without one keeps the class before it."""
    own = t.supplier.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("File"), (F.col("s_suppkey") % 7).cast("string"), F.lit(".java")).alias("file_name"), F.array(F.concat(F.lit("svc"), (F.col("s_suppkey") % 5).cast("string")), F.concat(F.lit("svc"), ((F.col("s_suppkey") + F.col("s_nationkey")) % 9).cast("string"))).alias("toks"))
    toks = own.select("id", "file_name", "toks", F.posexplode("toks").alias("pos", "var"))
    scoped = lookup.variable_types(t.var_types, ["file_name", "var"]).withColumnRenamed("var_type", "s")
    anywhere = lookup.variable_types(t.var_types, ["var"]).withColumnRenamed("var_type", "g")
    typed = toks.join(scoped, ["file_name", "var"], "left").join(anywhere, "var", "left").withColumn("cls", T.strip_generics(F.coalesce("s", "g")))
    return typed.groupBy("id").agg(F.coalesce(F.max_by("cls", F.when(F.col("cls").isNotNull(), F.col("pos"))), F.first(F.col("toks")[0])).alias("cls"))


@query("resolve_unqualified", """SELECT DISTINCT a.cls || '.' || a.mth AS caller, a.mth AS name, b.cls || '.' || b.mth AS target
    FROM (SELECT DISTINCT class_interface_name AS cls, method_name AS mth FROM {calls}) a JOIN (SELECT DISTINCT class_interface_name AS cls, method_name AS mth, type, access, annotations FROM {calls}) b ON lower(a.mth) = lower(b.mth)
    WHERE (b.type = 'class' AND b.access = 'private' AND a.cls = b.cls AND a.mth = b.mth) OR (b.type = 'class' AND b.access = 'public') OR (b.type = 'class_implements_interface' AND b.annotations LIKE '%@Override%') OR b.type = 'interface'""")
def resolve_unqualified(t: Tables) -> DataFrame:
    methods = t.calls.select(F.col("class_interface_name").alias("cls"), F.col("method_name").alias("mth"), "type", "access", "annotations").distinct()
    return lookup.resolve_unqualified(methods.select(F.concat_ws(".", "cls", "mth").alias("caller"), F.col("mth").alias("name")).distinct(), methods)


@query("props_lookup", "SELECT p_partkey, coalesce('v' || n.n_nationkey, 'NOT_FOUND') AS value FROM part LEFT JOIN nation n ON n.n_nationkey = p_partkey % 40")
def props_lookup(t: Tables) -> DataFrame:
    props = t.nation.select(F.concat(F.lit("key"), F.col("n_nationkey").cast("string")).alias("key"), F.concat(F.lit("v"), F.col("n_nationkey").cast("string")).alias("value"))
    refs = t.part.select("p_partkey", F.concat(F.lit("key"), (F.col("p_partkey") % 40).cast("string")).alias("key"))
    return refs.join(props, "key", "left").select("p_partkey", F.coalesce("value", F.lit("NOT_FOUND")).alias("value"))


@query("props_prefix_join", """SELECT k.key, p.prefix FROM (SELECT 'a' || (p_partkey % 3) || '.b' || (p_partkey % 5) || '.c' || p_partkey AS key FROM part) k
    JOIN (SELECT DISTINCT 'a' || (n_nationkey % 2) AS prefix FROM nation UNION SELECT 'a' || (n_nationkey % 4) || '.b' || (n_nationkey % 5) FROM nation) p ON k.key = p.prefix OR starts_with(k.key, p.prefix || '.')""")
def props_prefix_join(t: Tables) -> DataFrame:
    p, n = F.col("p_partkey"), F.col("n_nationkey")
    keys = t.part.select(F.concat(F.lit("a"), (p % 3).cast("string"), F.lit(".b"), (p % 5).cast("string"), F.lit(".c"), p.cast("string")).alias("key"))
    short = t.nation.select(F.concat(F.lit("a"), (n % 2).cast("string")).alias("prefix"))
    both = short.union(t.nation.select(F.concat(F.lit("a"), (n % 4).cast("string"), F.lit(".b"), (n % 5).cast("string")))).distinct()
    return lookup.prefix_join(keys, both)


_ASOF = "SELECT e.event_id, {agg} AS found FROM (SELECT * FROM events WHERE event_type <> 'signup') e LEFT JOIN (SELECT * FROM events WHERE event_type = 'signup') s ON s.user_id = e.user_id AND s.ts {op} e.ts GROUP BY 1"


@query("asof_enclosing", _ASOF.replace("{agg}", "max_by(s.event_id, s.ts)").replace("{op}", "<="))
def asof_enclosing(t: Tables) -> DataFrame:
    uses, decls = t.events.where("event_type <> 'signup'").select("event_id", "user_id", "ts"), t.events.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("decl"))
    return lookup.as_of_backward(uses, decls, "user_id", "ts", "ts", "decl").select("event_id", "found")


@query("asof_next", _ASOF.replace("{agg}", "min_by(s.event_id, s.ts)").replace("{op}", ">="))
def asof_next(t: Tables) -> DataFrame:
    uses, decls = t.events.where("event_type <> 'signup'").select("event_id", "user_id", "ts"), t.events.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("decl"))
    return lookup.as_of_forward(uses, decls, "user_id", "ts", "ts", "decl").select("event_id", "found")


@query("loc_lookup", "SELECT e.src, e.dst, coalesce(n.loc, 0) AS loc FROM {edges} e LEFT JOIN (SELECT * FROM {nodes} WHERE id % 4 <> 0) n ON n.id = e.dst")
def loc_lookup(t: Tables) -> DataFrame:
    known = t.nodes.where("id % 4 <> 0").select(F.lower("mth").alias("k"), "loc")
    called = t.edges.withColumn("k", F.lower(F.concat(F.lit("M"), F.col("dst").cast("string"))))
    return called.join(known, "k", "left").select("src", "dst", F.coalesce("loc", F.lit(0)).alias("loc"))


@query("drop_external", f"SELECT l_orderkey, l_linenumber, object_call FROM (SELECT *, {_BASE} AS base FROM {{calls}}) WHERE base IS NULL OR base NOT IN ('Ext0', 'Ext1', 'repo0')")
def drop_external(t: Tables) -> DataFrame:
    k = (F.col("n_nationkey") % 2).cast("string")
    external = t.nation.select(F.explode(F.array(F.concat(F.lit("Ext"), k), F.lit("repo0"))).alias("cls")).distinct()
    return lookup.external_bases(t.calls, T.call_base(F.col("object_call")), external).select(*KEY, "object_call")


@query("drop_system_methods", f"SELECT l_orderkey, l_linenumber, object_call FROM (SELECT *, {_CALLED} AS called FROM {{calls}}) WHERE called IS NULL OR lower(called) NOT IN ({_SQL_METHODS})")
def drop_system_methods(t: Tables) -> DataFrame:
    called = F.lower("called")
    return calls_of(t).where(called.isNull() | ~called.isin(*T.SYSTEM_METHODS)).select(*KEY, "object_call")


@query("drop_object_dup", """SELECT c.l_orderkey, c.l_linenumber, c.object_call FROM {calls} c WHERE c.object_call IS NULL OR left(c.object_call, 1) BETWEEN 'A' AND 'Z' OR NOT EXISTS (
    SELECT 1 FROM {calls} u WHERE u.file_name = c.file_name AND u.class_interface_name = c.class_interface_name AND u.method_name = c.method_name AND u.object_call = upper(left(c.object_call, 1)) || substr(c.object_call, 2))""")
def drop_object_dup(t: Tables) -> DataFrame:
    return lookup.drop_object_twins(t.calls, ["file_name", "class_interface_name", "method_name"], "object_call").select(*KEY, "object_call")


# --- explode ------------------------------------------------------------------------------------------------------------


@query("explode_calls", "SELECT o_orderkey, coalesce(c.object_call, 'None') AS object_call FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, object_call FROM {calls} WHERE object_call IS NOT NULL) c ON l_orderkey = o_orderkey")
def explode_calls(t: Tables) -> DataFrame:
    sets = t.calls.groupBy("l_orderkey").agg(F.collect_set("object_call").alias("calls"))
    return t.orders.join(sets, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.explode_outer("calls").alias("c")).select("o_orderkey", F.coalesce("c", F.lit("None")).alias("object_call"))


_DETAIL_CHAINS = r"(SELECT id, file_name, 'Svc' || (id % 5) AS cls, string_split(regexp_replace(object_call, '\([^)]*\)', '', 'g'), '.')[2:] AS methods FROM {details} WHERE id % 8 > 3)"


@query(
    "explode_details",
    f"""WITH RECURSIVE {_WALK}, c AS {_DETAIL_CHAINS},
        walk AS (SELECT c.id, c.file_name, c.methods, 1 AS pos, coalesce(s.owner, c.cls) AS owner, c.methods[1] AS method, s.next FROM c LEFT JOIN steps s ON s.cls = c.cls AND s.method = c.methods[1]
                 UNION ALL SELECT w.id, w.file_name, w.methods, w.pos + 1, coalesce(s.owner, w.next), w.methods[w.pos + 1], s.next FROM walk w LEFT JOIN steps s ON s.cls = w.next AND s.method = w.methods[w.pos + 1] WHERE w.next IS NOT NULL AND w.pos < len(w.methods))
        SELECT DISTINCT file_name, detail FROM (SELECT file_name, owner || '.' || method || '()' AS detail FROM walk
            UNION ALL SELECT file_name, CASE id % 8 WHEN 0 THEN 'None' WHEN 3 THEN object_call ELSE 'Svc' || (id % 5) || '.m' || (id % 11) || '()' END FROM {{details}} WHERE id % 8 < 4)""",
)
def explode_details(t: Tables) -> DataFrame:
    """Of a chain a row for each segment that its types lead to, single calls as Base.method(), the rest as it is; then distinct."""
    call = F.col("object_call")
    plain = T.strip_generics(T.strip_parens(call))
    parts = F.split(plain, r"\.")
    own = materialize(t.details.select("id", "file_name", "object_call", parts.alias("parts"), call.rlike(r"\([^)]*\)\s*\.").alias("chained")))
    chained = own.where("chained").select("id", F.get("parts", F.lit(0)).alias("cls"), F.slice("parts", F.lit(2), F.size("parts") - 1).alias("methods"))
    segments = lookup.chain_segments(chained, lookup.chain_steps(t.returns, t.parents)).join(own.select("id", "file_name"), "id").select("file_name", F.col("segment").alias("detail"))
    single = F.when(F.size("parts") == 2, F.concat(F.array_join("parts", "."), F.lit("()"))).otherwise(call)
    rest = own.where("NOT coalesce(chained, false)").select("file_name", F.coalesce(single, F.lit("None")).alias("detail"))
    return segments.unionByName(rest).distinct()


@query("flatten_lists", "SELECT c_nationkey, string_agg(x, ',' ORDER BY c_custkey, k) AS names FROM (SELECT c_nationkey, c_custkey, unnest([c_name, upper(c_name)]) AS x, unnest([1, 2]) AS k FROM customer) GROUP BY 1")
def flatten_lists(t: Tables) -> DataFrame:
    nested = ordering.ordered_list(F.array("c_name", F.upper("c_name")), ["c_custkey"])
    return t.customer.groupBy("c_nationkey").agg(F.array_join(F.flatten(nested), ",").alias("names"))


# --- order --------------------------------------------------------------------------------------------------------------


@query("decl_rank", "SELECT class_interface_name, method_name, row_number() OVER (ORDER BY f, class_interface_name, method_name) - 1 AS rank FROM (SELECT class_interface_name, method_name, min((file_name, l_orderkey, l_linenumber)) AS f FROM {calls} GROUP BY 1, 2)")
def decl_rank(t: Tables) -> DataFrame:
    first = t.calls.groupBy("class_interface_name", "method_name").agg(F.min(F.struct("file_name", "l_orderkey", "l_linenumber")).alias("f"))
    return ordering.global_rank(first, ["f", "class_interface_name", "method_name"], "rank").select("class_interface_name", "method_name", "rank")


@query("method_id", "SELECT 'M' || lpad(CAST(row_number() OVER (ORDER BY class_interface_name, method_name) AS VARCHAR), 4, '0') AS id, class_interface_name, method_name FROM (SELECT DISTINCT class_interface_name, method_name FROM {calls})")
def method_id(t: Tables) -> DataFrame:
    names = t.calls.select("class_interface_name", "method_name").distinct()
    return ordering.global_rank(names, ["class_interface_name", "method_name"], "k", 1).select(F.concat(F.lit("M"), F.lpad(F.col("k").cast("string"), 4, "0")).alias("id"), "class_interface_name", "method_name")


@query("row_order", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events")
def row_order(t: Tables) -> DataFrame:
    return ordering.global_rank(t.events.select("event_id", "ts"), ["ts", "event_id"], "pos").select("event_id", "pos")


_RUNS = """SELECT {key}, {val} AS value, min(pos) AS first, max(pos) AS last, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY {key} ORDER BY pos) AS run FROM (
    SELECT {key}, {val}, row_number() OVER w - 1 AS pos, CASE WHEN {val} IS NOT DISTINCT FROM lag({val}) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY {ord}))) GROUP BY {key}, run, {val}"""


def _runs(key: str, val: str, src: str, order: str) -> str:
    return _RUNS.replace("{key}", key).replace("{val}", val).replace("{src}", src).replace("{ord}", order)


@query("merge_runs", _runs("user_id", "event_type", "events", "ts, event_id"))
def merge_runs(t: Tables) -> DataFrame:
    return ordering.runs(t.events.select("user_id", "event_type", "ts", "event_id"), ["user_id"], "event_type", ["ts", "event_id"]).withColumnRenamed("event_type", "value")


@query("group_runs", """SELECT l1 AS value, min(pos) AS first, max(pos) AS last, count(*) AS n FROM (SELECT *, sum(new) OVER (ORDER BY pos) AS run FROM (
    SELECT l1, row_number() OVER w - 1 AS pos, CASE WHEN l1 IS NOT DISTINCT FROM lag(l1) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM {paths} WINDOW w AS (ORDER BY id))) GROUP BY run, l1""")
def group_runs(t: Tables) -> DataFrame:
    """Consecutive rows of one root, over the whole sheet."""
    return ordering.global_runs(t.paths.select("l1", "id"), "l1", ["id"]).withColumnRenamed("l1", "value")


@query("forward_fill", "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS filled FROM events")
def forward_fill(t: Tables) -> DataFrame:
    e = t.events.withColumn("v", F.when(F.col("event_type") == "signup", F.col("event_id")))
    return ordering.forward_fill(e, ["user_id"], "v", ["ts", "event_id"], "filled").select("event_id", "filled")


@query("suppress_repeats", """SELECT id, l1, CASE WHEN rn > 1 AND p2 THEN NULL ELSE l2 END AS l2, CASE WHEN rn > 1 AND p2 AND p3 THEN NULL ELSE l3 END AS l3 FROM (
    SELECT *, l2 IS NOT DISTINCT FROM lag(l2) OVER w AS p2, l3 IS NOT DISTINCT FROM lag(l3) OVER w AS p3, row_number() OVER w AS rn FROM {paths} WINDOW w AS (PARTITION BY l1 ORDER BY l2, l3, id))""")
def suppress_repeats(t: Tables) -> DataFrame:
    return ordering.suppress_repeats(t.paths.select("id", "l1", "l2", "l3", F.col("l2").alias("o2"), F.col("l3").alias("o3")), ["l1"], ["l2", "l3"], ["l1", "o2", "o3", "id"]).select("id", "l1", "l2", "l3")


@query("brace_depth", "SELECT event_id, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM events")
def brace_depth(t: Tables) -> DataFrame:
    step = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "error", -1).otherwise(0)
    return ordering.running_depth(t.events, ["user_id"], step, ["ts", "event_id"], "depth").select("event_id", "depth")


@query("limit_preview", "SELECT l_orderkey, l_linenumber, object_call FROM {calls} WHERE object_call IS NOT NULL ORDER BY object_call, l_orderkey, l_linenumber, l_partkey, l_suppkey, loc LIMIT 10")
def limit_preview(t: Tables) -> DataFrame:
    return t.calls.where("object_call IS NOT NULL").orderBy("object_call", *ORDER).limit(10).select(*KEY, "object_call")


# --- sets ---------------------------------------------------------------------------------------------------------------


@query(
    "callee_pairs",
    f"""WITH declared AS (SELECT DISTINCT class_interface_name AS cls, method_name AS mth FROM {{calls}}), c AS (SELECT *, {_BASE} AS base, {_CALLED} AS called FROM {{calls}})
        SELECT DISTINCT base AS cls, called AS mth FROM c WHERE base IS NOT NULL AND called IS NOT NULL
        UNION SELECT DISTINCT d.cls, d.mth FROM c JOIN declared d ON d.cls = class_interface_name AND d.mth = called WHERE base IS NULL AND object_call LIKE '%(%'""",
)
def callee_pairs(t: Tables) -> DataFrame:
    declared = t.calls.select(F.col("class_interface_name").alias("cls"), F.col("method_name").alias("mth")).distinct()
    c = calls_of(t)
    qualified = c.where("base IS NOT NULL AND called IS NOT NULL").select(F.col("base").alias("cls"), F.col("called").alias("mth"))
    bare = c.where("base IS NULL").where(F.col("object_call").contains("(")).select(F.col("class_interface_name").alias("cls"), F.col("called").alias("mth")).join(declared, ["cls", "mth"], "left_semi")
    return qualified.union(bare).distinct()


@query(
    "unique_methods",
    """WITH a AS (SELECT DISTINCT class_interface_name AS cls, method_name AS mth FROM {calls} WHERE parameters IS NOT NULL), b AS (SELECT DISTINCT cls, method AS mth FROM {returns}), c AS (SELECT DISTINCT cls, mth FROM {nodes})
       SELECT cls, mth, min(src) AS src FROM (SELECT *, 0 AS src FROM a UNION ALL SELECT *, 1 FROM b UNION ALL SELECT *, 2 FROM c) GROUP BY 1, 2""",
)
def unique_methods(t: Tables) -> DataFrame:
    a = t.calls.where("parameters IS NOT NULL").select(F.col("class_interface_name").alias("cls"), F.col("method_name").alias("mth"), F.lit(0).alias("src")).distinct()
    b = t.returns.select("cls", F.col("method").alias("mth"), F.lit(1).alias("src")).distinct()
    c = t.nodes.select("cls", "mth", F.lit(2).alias("src"))
    return ordering.priority_union([a, b, c], ["cls", "mth"], ["src"])


@query("child_method_union", "SELECT parent, string_agg(DISTINCT name, '|' ORDER BY name) AS names FROM {chunk_edges} e JOIN (SELECT chunk, trim(split_part(token, ' no_of_lines', 1)) AS name FROM {tokens} WHERE NOT regexp_matches(token, '^C[0-9]{3}_.+')) k ON k.chunk = e.child GROUP BY 1")
def child_method_union(t: Tables) -> DataFrame:
    names = t.tokens.select(F.col("chunk").alias("child"), T.parse_token(F.col("token")).alias("t")).where("t.kind = 'method'").select("child", F.col("t.name").alias("name"))
    return t.chunk_edges.join(names, "child").groupBy("parent").agg(F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"))


@query("sheet_scan", "SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_size > 25")
def sheet_scan(t: Tables) -> DataFrame:
    """Filter and columns reach the scan."""
    return t.part.where("p_size > 25").select("p_partkey", "p_name", "p_brand", "p_size")
