"""Queries over the call graph, its paths, their reordering, and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.jobs.fixtures import Tables
from calltrail.jobs.registry import query
from calltrail.operators import graph, lookup, matching, ordering
from calltrail.operators.shared import materialize, new_path
from calltrail.sources.files import read_sheet, require_columns, write_sheets

#: All paths from the first node as SQL, for checks: bare names are resolved by visibility, else stay in the caller's class.
_PATHS = """e AS (SELECT DISTINCT lower(caller) AS src, lower(CASE WHEN strpos(name, '.') > 0 THEN name ELSE coalesce(m.cls || '.' || m.mth, split_part(caller, '.', 1) || '.' || name) END) AS dst
        FROM (SELECT caller, split_part(callee, '(', 1) AS name FROM {named_calls}) c
        LEFT JOIN (SELECT DISTINCT * FROM {named_methods}) m ON m.mth = c.name AND (m.type = 'interface' OR m.access = 'public' OR m.cls || '.' || m.mth = c.caller)),
    w AS (SELECT 'cls0.m0' AS node, ['cls0.m0'] AS path, false AS ended UNION ALL SELECT e.dst, list_append(w.path, e.dst), list_contains(w.path, e.dst) FROM w JOIN e ON e.src = w.node WHERE NOT w.ended),
    p AS (SELECT path FROM w WHERE ended OR node NOT IN (SELECT src FROM e))"""


def paths(t: Tables) -> DataFrame:
    """Paths of methods by name; bare callees are expanded before any path is walked."""
    root = t.nodes.where("id = 0").select(F.lower(F.concat_ws(".", "cls", "mth")).alias("node"))
    return graph.simple_paths(graph.resolved_edges(t.named_calls, t.named_methods), root)


@query("flow_paths", f"WITH RECURSIVE {_PATHS} SELECT 'cls0.m0' AS root, CAST(len(path) AS INTEGER) AS levels, array_to_string(path, '>') AS path FROM p")
def flow_paths(t: Tables) -> DataFrame:
    return paths(t).select("root", F.size("path").alias("levels"), F.array_join("path", ">").alias("path"))


@query("flow_wide", f"WITH RECURSIVE {_PATHS}, n AS (SELECT max(len(path)) AS n FROM p) SELECT CAST(n AS INTEGER) AS width, array_to_string(list_transform(range(1, n + 1), lambda k: coalesce(path[k], '')), '|') AS cells FROM p, n")
def flow_wide(t: Tables) -> DataFrame:
    """The wide table has as many level columns as the longest path has nodes; here all its cells as one text, beside their number."""
    found = materialize(paths(t))
    width = found.agg(F.coalesce(F.max(F.size("path")), F.lit(0))).first()[0]
    wide = graph.wide(found, [], width)
    return wide.select(F.lit(width).alias("width"), F.concat_ws("|", *[F.col(c) for c in wide.columns]).alias("cells"))


@query("flow_inverted", "SELECT l4, l3, l2, l1, id FROM {paths}")
def flow_inverted(t: Tables) -> DataFrame:
    p = t.paths
    return p.select(*reversed(p.columns))


@query("flow_root_visible", """WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM {edges} WHERE src % 7 <> 3 AND dst % 7 <> 3), r AS (SELECT p_partkey AS node FROM part),
    w AS (SELECT node AS root, node, [node] AS path, false AS ended FROM r WHERE node % 7 <> 3 UNION ALL SELECT w.root, e.dst, list_append(w.path, e.dst), list_contains(w.path, e.dst) FROM w JOIN e ON e.src = w.node WHERE NOT w.ended),
    p AS (SELECT root, count(*) AS n FROM w WHERE ended OR node NOT IN (SELECT src FROM e) GROUP BY 1)
    SELECT r.node AS root, coalesce(p.n, 1) AS n FROM r LEFT JOIN p ON p.root = r.node""")
def flow_root_visible(t: Tables) -> DataFrame:
    """Roots that are pruned themselves still show as a path of one node."""
    roots = t.part.select(F.col("p_partkey").alias("node"))
    pruned = t.part.where("p_partkey % 7 = 3").select(F.col("p_partkey").alias("node"))
    found = graph.simple_paths(t.edges, roots, pruned)
    shown = found.unionByName(roots.join(found.select(F.col("root").alias("node")).distinct(), "node", "left_anti").select(F.col("node").alias("root"), F.array("node").alias("path")))
    return shown.groupBy("root").agg(F.count("*").alias("n"))


@query("prune_nodes", "SELECT src, dst FROM {edges} WHERE src % 7 <> 3 AND dst % 7 <> 3")
def prune_nodes(t: Tables) -> DataFrame:
    pruned = t.part.where("p_partkey % 7 = 3").select(F.col("p_partkey").alias("node"))
    return t.edges.join(pruned.withColumnRenamed("node", "src"), "src", "left_anti").join(pruned.withColumnRenamed("node", "dst"), "dst", "left_anti").select("src", "dst")


@query("reachable_files", """WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM {edges} WHERE dst % 5 <> 3),
    w AS (SELECT CAST(0 AS BIGINT) AS node UNION SELECT e.dst FROM w JOIN e ON e.src = w.node) SELECT node FROM w""")
def reachable_files(t: Tables) -> DataFrame:
    """All files reached from the first over all references; some references lead nowhere."""
    return graph.reachable(t.edges.where("dst % 5 <> 3"), t.part.where("p_partkey = 0").select(F.col("p_partkey").alias("node"))).select("node")


_REFS = "(SELECT p_partkey AS src, unnest([2 * p_partkey + 2, 2 * p_partkey + 1, CASE WHEN p_partkey % 7 = 0 THEN 2 * p_partkey + 5 END, p_partkey // 3]) AS dst, unnest([1, 0, 2, 3]) AS place FROM part)"


@query("discovery_order", f"""WITH RECURSIVE e AS (SELECT * FROM {_REFS} WHERE dst IN (SELECT p_partkey FROM part) AND dst > src), s AS (SELECT 3 AS node, [0] AS path UNION ALL SELECT 1, [1]),
    w AS (SELECT CAST(node AS BIGINT) AS node, 0 AS round, path FROM s UNION ALL SELECT e.dst, w.round + 1, list_append(w.path, e.place) FROM w JOIN e ON e.src = w.node),
    d AS (SELECT node, min(round) AS round FROM w GROUP BY 1), b AS (SELECT node, round, min(path) AS path FROM w JOIN d USING (node, round) GROUP BY 1, 2)
    SELECT node, CAST(round AS INTEGER) AS round, row_number() OVER (ORDER BY round, path) - 1 AS number FROM b""")
def discovery_order(t: Tables) -> DataFrame:
    """Files in the order of a queue from two seeds; some have several parents, some references lead back or nowhere."""
    p = F.col("p_partkey")
    refs = F.array(*[F.struct(d.cast("long").alias("dst"), F.lit(k).alias("place")) for k, d in ((1, 2 * p + 2), (0, 2 * p + 1), (2, F.when(p % 7 == 0, 2 * p + 5)), (3, F.floor(p / 3)))])
    edges = t.part.select(p.alias("src"), F.inline(refs)).where("dst IS NOT NULL").join(t.part.select(p.alias("dst")), "dst", "left_semi").where("dst > src OR place = 3 AND dst IN (1, 3)")
    seeds = t.part.where("p_partkey IN (1, 3)").select(p.alias("node"), F.when(p == 3, 0).otherwise(1).alias("place"))
    return graph.discovery(edges, seeds)


_OWNED = "(SELECT cls, mth, 'src/' || cls AS file, id AS nr FROM {nodes} UNION ALL SELECT 'Zed', mth, 'src/Zed', 1000000000 FROM {nodes} WHERE id % 10 = 0)"
_NAMED = "(SELECT s.cls, s.mth, CASE WHEN e.dst % 4 = 1 THEN d.mth || '()' WHEN e.dst % 4 = 2 THEN 'Other.' || d.mth || '(a.b)' ELSE d.cls || '.' || d.mth || '()' END AS call FROM {edges} e JOIN {nodes} s ON s.id = e.src JOIN {nodes} d ON d.id = e.dst UNION ALL SELECT 'Zed', mth, 'Zed.lost()' FROM {nodes} WHERE id % 10 = 0 UNION ALL SELECT cls, mth, 'ext.gone()' FROM {nodes} WHERE id % 9 = 0)"
_NAME = "split_part(split_part({}, '(', 1), '.', -1)"


@query("closure_by_name", f"""WITH RECURSIVE o AS (SELECT mth, min_by(cls, nr) AS cls, min_by(file, nr) AS file FROM {_OWNED} GROUP BY 1), c AS (SELECT o.mth, o.file, n.call FROM o LEFT JOIN (SELECT DISTINCT * FROM {_NAMED}) n USING (cls, mth)),
    s AS (SELECT 'Any.m' || n_nationkey AS start FROM nation UNION ALL SELECT 'm' || n_nationkey || '(x.y)' FROM nation WHERE n_nationkey % 5 = 0),
    w AS (SELECT start, start AS current FROM s UNION SELECT w.start, c.call FROM w JOIN c ON c.mth = {_NAME.format('w.current')} WHERE c.call IS NOT NULL)
    SELECT start, coalesce(file, 'Unknown') AS file, current, coalesce(call, '') AS call FROM w LEFT JOIN c ON c.mth = {_NAME.format('w.current')}""")
def closure_by_name(t: Tables) -> DataFrame:
    """From a start for each nation, and a bare one of the same name for each fifth. The later owner of a name is never reached."""
    starts = t.nation.select(F.concat(F.lit("Any.m"), F.col("n_nationkey").cast("string")).alias("start")).union(t.nation.where("n_nationkey % 5 = 0").select(F.concat(F.lit("m"), F.col("n_nationkey").cast("string"), F.lit("(x.y)"))))
    tenth, zed = t.nodes.where("id % 10 = 0"), F.lit("Zed")
    methods = t.nodes.select("cls", "mth", F.concat(F.lit("src/"), "cls").alias("file"), F.col("id").alias("at")).union(tenth.select(zed, "mth", F.lit("src/Zed"), F.lit(1000000000)))
    s, d = t.nodes.select(F.col("id").alias("src"), "cls", "mth"), t.nodes.select(F.col("id").alias("dst"), F.col("cls").alias("c"), F.col("mth").alias("m"))
    text = F.when(F.col("dst") % 4 == 1, F.concat("m", F.lit("()"))).when(F.col("dst") % 4 == 2, F.concat(F.lit("Other."), "m", F.lit("(a.b)"))).otherwise(F.concat("c", F.lit("."), "m", F.lit("()")))
    calls_ = t.edges.join(s, "src").join(d, "dst").select("cls", "mth", text.alias("call")).union(tenth.select(zed, "mth", F.lit("Zed.lost()"))).union(t.nodes.where("id % 9 = 0").select("cls", "mth", F.lit("ext.gone()")))
    return graph.closure_by_name(methods, calls_, starts)


_FLOW = """m AS (SELECT lower(cls || '.' || mth) AS node, cls || '.' || mth AS name FROM {nodes} UNION ALL SELECT lower(cls || 'Impl.' || mth), cls || 'Impl.' || mth FROM {nodes} WHERE id % 6 = 5),
    c AS (SELECT s.cls || '.' || s.mth AS src, d.cls || '.' || d.mth AS dst FROM {edges} e JOIN {nodes} s ON s.id = e.src JOIN {nodes} d ON d.id = e.dst WHERE e.dst > e.src
        UNION ALL SELECT cls || 'Impl.' || mth, 'Ext.run' || (id % 3) FROM {nodes} WHERE id % 6 = 5 UNION ALL SELECT cls || '.' || mth, 'Lib.go' FROM {nodes} WHERE id % 11 = 0),
    r AS (SELECT DISTINCT lower(c.src) AS src, lower(coalesce(i.name, c.dst)) AS dst, coalesce(i.name, c.dst) AS shown FROM c LEFT JOIN m i ON i.node = lower(split_part(c.dst, '.', 1) || 'impl.' || split_part(c.dst, '.', 2))),
    k AS (SELECT * FROM r WHERE split_part(src, '.', 1) NOT IN ('cls3', 'lib') AND split_part(dst, '.', 1) NOT IN ('cls3', 'lib')),
    loc AS (SELECT lower(cls || '.' || mth) AS node, loc FROM {nodes} WHERE id % 4 <> 0),
    l AS (SELECT k.src, coalesce(m.name, k.src) || ' no_of_lines : ' || coalesce(a.loc, 0) AS a, k.shown || ' no_of_lines : ' || coalesce(b.loc, 0) AS b FROM k LEFT JOIN m ON m.node = k.src LEFT JOIN loc a ON a.node = k.src LEFT JOIN loc b ON b.node = k.dst)"""


@query("flow_labelled", f"""WITH RECURSIVE {_FLOW}, w AS (SELECT 'Cls0.m0 no_of_lines : 0' AS node, ['Cls0.m0 no_of_lines : 0'] AS path, false AS ended UNION ALL SELECT l.b, list_append(w.path, l.b), list_contains(w.path, l.b) FROM w JOIN l ON l.a = w.node WHERE NOT w.ended)
    SELECT CAST(len(path) AS INTEGER) AS levels, array_to_string(path, '>') AS path FROM w WHERE ended OR node NOT IN (SELECT a FROM l)""")
def flow_labelled(t: Tables) -> DataFrame:
    """Paths of labels with lines: callees go to their implementations, classes of a list vanish, platform callees are leaves."""
    name = lambda n: F.concat_ws(".", f"{n}.cls", f"{n}.mth")
    sixth = t.nodes.where("id % 6 = 5")
    impl = F.concat("cls", F.lit("Impl"))
    rest = [F.lit("class").alias("type"), F.lit("public").alias("access"), F.lit("").alias("annotations")]
    methods = t.nodes.select("cls", "mth", *rest).union(sixth.select(impl, "mth", *rest))
    s, d = t.nodes.alias("s"), t.nodes.alias("d")
    calls_ = t.edges.where("dst > src").join(s, F.col("src") == F.col("s.id")).join(d, F.col("dst") == F.col("d.id")).select(name("s").alias("caller"), name("d").alias("callee"))
    calls_ = calls_.union(sixth.select(F.concat_ws(".", impl, "mth"), F.concat(F.lit("Ext.run"), (F.col("id") % 3).cast("string"), F.lit("(x)")))).union(t.nodes.where("id % 11 = 0").select(F.concat_ws(".", "cls", "mth"), F.lit("Lib.go")))
    pruned = t.region.where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, F.lit("CLS3")).otherwise(F.lit("Lib")).alias("cls"))
    edges, labels = graph.flow_edges(calls_, methods, t.nodes.where("id % 4 <> 0"), pruned)
    return graph.simple_paths(edges, labels.where("node = 'cls0.m0'").select(F.col("label").alias("node"))).select(F.size("path").alias("levels"), F.array_join("path", ">").alias("path"))


@query("call_closure", """WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM {edges}), s AS (SELECT p_partkey AS start FROM part),
    w AS (SELECT start, start AS node FROM s UNION SELECT w.start, e.dst FROM w JOIN e ON e.src = w.node) SELECT w.start, e.src, e.dst FROM w JOIN e ON e.src = w.node""")
def call_closure(t: Tables) -> DataFrame:
    """From every method."""
    return graph.closure(t.edges, t.part.select(F.col("p_partkey").alias("start")))


@query("graph_edges", "SELECT src, string_agg(DISTINCT CAST(dst AS VARCHAR), ',' ORDER BY CAST(dst AS VARCHAR)) AS dsts FROM {edges} GROUP BY 1")
def graph_edges(t: Tables) -> DataFrame:
    return t.edges.groupBy("src").agg(F.array_join(F.array_sort(F.collect_set(F.col("dst").cast("string"))), ",").alias("dsts"))


@query("graph_targets", """WITH c AS (SELECT DISTINCT class_interface_name || '.' || method_name AS caller, split_part(object_call, '(', 1) AS callee FROM {calls} WHERE lower(object_call) NOT IN ('', 'none')),
    n AS (SELECT DISTINCT method_name AS m, class_interface_name || '.' || method_name AS node FROM {calls})
    SELECT DISTINCT caller, CASE WHEN strpos(callee, '.') > 0 THEN callee ELSE coalesce(n.node, callee) END AS target FROM c LEFT JOIN n ON n.m = c.callee""")
def graph_targets(t: Tables) -> DataFrame:
    """Qualified calls as they are; bare names go to every node of that name, or stay."""
    node = F.concat_ws(".", "class_interface_name", "method_name")
    called = t.calls.where(~T.is_sentinel(F.col("object_call"))).select(node.alias("caller"), F.trim(F.substring_index("object_call", "(", 1)).alias("callee")).distinct()
    nodes = t.calls.select(F.col("method_name").alias("callee"), node.alias("node")).distinct()
    return called.join(nodes, "callee", "left").select("caller", F.when(F.col("callee").contains("."), F.col("callee")).otherwise(F.coalesce("node", "callee")).alias("target")).distinct()


@query("start_nodes", """WITH want AS (SELECT 'cls' || r_regionkey AS w FROM region UNION ALL SELECT 'm1' UNION ALL SELECT 'm7'), a AS (SELECT w, cls, mth FROM want JOIN {nodes} ON lower(cls) = w)
    SELECT w, cls, mth FROM a UNION SELECT want.w, cls, mth FROM want JOIN {nodes} ON lower(mth) = want.w WHERE want.w NOT IN (SELECT w FROM a)""")
def start_nodes(t: Tables) -> DataFrame:
    """By class name; names that match no class are looked up as file stems (here: method names)."""
    regions = t.region.select(F.concat(F.lit("cls"), F.col("r_regionkey").cast("string")).alias("w"))
    want = regions.union(t.region.where("r_regionkey IN (1, 2)").select(F.when(F.col("r_regionkey") == 1, F.lit("m1")).otherwise(F.lit("m7"))))
    by_class = want.join(t.nodes.withColumn("w", F.lower("cls")), "w").select("w", "cls", "mth")
    rest = want.join(by_class.select("w").distinct(), "w", "left_anti")
    return by_class.union(rest.join(t.nodes.withColumn("w", F.lower("mth")), "w").select("w", "cls", "mth")).distinct()


@query("drop_nested_roots", "SELECT id, l1, l2 FROM (SELECT id, l1, CASE WHEN id % 10 = 0 THEN 'R' || (id % 3) || '.r' ELSE l2 END AS l2 FROM {paths}) WHERE l1 NOT IN (SELECT CASE WHEN id % 10 = 0 THEN 'R' || (id % 3) || '.r' ELSE l2 END FROM {paths})")
def drop_nested_roots(t: Tables) -> DataFrame:
    p = t.paths.select("id", "l1", F.when(F.col("id") % 10 == 0, F.concat(F.lit("R"), (F.col("id") % 3).cast("string"), F.lit(".r"))).otherwise(F.col("l2")).alias("l2"))
    return p.join(p.select(F.col("l2").alias("l1")).distinct(), "l1", "left_anti").select("id", "l1", "l2")


@query("blank_zero_loc", r"SELECT id, l1, l2, l3, CASE WHEN regexp_matches(lower(l4), 'no_of_lines\s*:\s*0$') THEN NULL ELSE l4 END AS l4 FROM (SELECT id, l1, CASE WHEN regexp_matches(lower(l2), 'no_of_lines\s*:\s*0$') THEN NULL ELSE l2 END AS l2, l3, l4 FROM {paths})")
def blank_zero_loc(t: Tables) -> DataFrame:
    zero = r"(?i)no_of_lines\s*:\s*0$"
    return t.paths.select("id", *[F.when(~F.coalesce(F.col(c).rlike(zero), F.lit(False)), F.col(c)).alias(c) for c in ("l1", "l2", "l3", "l4")])


@query("occurrences", """WITH c AS (SELECT id, lower(l1) AS root, unnest([2, 3]) AS level, lower(unnest([l2, l3])) AS cell FROM {paths}), s AS (SELECT DISTINCT lower('N' || n_nationkey) AS stem FROM nation)
    SELECT stem, root, level, count(*) AS n FROM c JOIN s ON strpos(c.cell, s.stem) > 0 GROUP BY 1, 2, 3""")
def occurrences(t: Tables) -> DataFrame:
    """How often a file's stem is part of a cell, by root and level. Only distinct cells are looked at."""
    cells = ordering.unpivot(t.paths, ["id", "l1"], ["l2", "l3"]).select(F.lower("l1").alias("root"), (F.col("level") + 1).alias("level"), F.lower("cell").alias("cell"))
    cells = cells.where("cell IS NOT NULL").groupBy("root", "level", "cell").agg(F.count("*").alias("k"))
    stems = t.nation.select(F.lower(F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).alias("stem")).distinct()
    hits = matching.contained(cells.select("cell").distinct(), stems)
    return cells.join(hits, "cell").groupBy("stem", "root", "level").agg(F.sum("k").alias("n"))


@query("short_stems", """WITH s AS (SELECT DISTINCT lower(substr(s_name, 1 + s_suppkey % 9, 1 + s_suppkey % 4)) AS stem FROM supplier), c AS (SELECT p_partkey, lower(p_name) AS cell FROM part)
    SELECT p_partkey, stem FROM c JOIN s ON strpos(cell, stem) > 0""")
def short_stems(t: Tables) -> DataFrame:
    """Stems of one to four characters in names: frequent ones cost their hits alone."""
    k = F.col("s_suppkey")
    stems = t.supplier.select(F.lower(F.substring(F.col("s_name"), (1 + k % 9).cast("int"), (1 + k % 4).cast("int"))).alias("stem"))
    names = t.part.select("p_partkey", F.lower("p_name").alias("cell"))
    return names.join(matching.contained(names.select("cell").distinct(), stems, most_chars=64), "cell").select("p_partkey", "stem")


# --- reordering -------------------------------------------------------------------------------------------------------


def decl_ranks(t: Tables) -> DataFrame:
    """cls, mth, rank of the nodes: by size of the part, then key."""
    return ordering.global_rank(t.part.select("p_partkey", "p_size"), ["p_size", "p_partkey"], "rank").select(F.concat(F.lit("cls"), (F.col("p_partkey") % 7).cast("string")).alias("cls"), F.concat(F.lit("m"), (F.col("p_partkey") % 300).cast("string")).alias("mth"), "rank")


_RANKS = "(SELECT 'cls' || (p_partkey % 7) AS cls, 'm' || (p_partkey % 300) AS mth, row_number() OVER (ORDER BY p_size, p_partkey) - 1 AS rank FROM part)"


@query("decl_rank_lookup", f"SELECT o.o_orderkey, coalesce((SELECT min(rank) FROM {_RANKS} r WHERE r.cls = o.cls AND r.mth = o.mth), (SELECT min(rank) FROM {_RANKS} r WHERE r.mth = o.mth), 1000000000) AS rank FROM (SELECT o_orderkey, 'cls' || (o_orderkey % 9) AS cls, 'm' || (o_custkey % 400) AS mth FROM orders) o")
def decl_rank_lookup(t: Tables) -> DataFrame:
    cells = t.orders.select("o_orderkey", F.concat(F.lit("cls"), (F.col("o_orderkey") % 9).cast("string")).alias("cls"), F.concat(F.lit("m"), (F.col("o_custkey") % 400).cast("string")).alias("mth"))
    return lookup.rank_with_fallback(cells, decl_ranks(t)).select("o_orderkey", "rank")


_CALL_RANKS = "(SELECT 'cls' || (src % 7) AS cls, 'm' || (src % 20) AS mth, CASE WHEN dst % 3 = 0 THEN NULL ELSE 'cls' || (dst % 5) END AS recv, 'm' || (dst % 30) AS callee, dst % 50 AS rank FROM {edges})"


def call_ranks(t: Tables) -> DataFrame:
    s, d = F.col("src"), F.col("dst")
    text = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    return t.edges.select(text("cls", s % 7).alias("cls"), text("m", s % 20).alias("mth"), F.when(d % 3 != 0, text("cls", d % 5)).alias("recv"), text("m", d % 30).alias("callee"), (d % 50).alias("rank"))


@query(
    "call_rank_lookup",
    f"""WITH r AS {_CALL_RANKS}, c AS (SELECT o_orderkey, 'cls' || (o_orderkey % 7) AS pcls, 'm' || (o_orderkey % 20) AS pmth, 'cls' || (o_custkey % 5) AS cls, 'm' || (o_custkey % 40) AS mth FROM orders)
        SELECT o_orderkey, coalesce(
          (SELECT min(rank) FROM r WHERE r.cls = c.pcls AND r.mth = c.pmth AND r.callee = c.mth AND (r.recv IS NULL OR r.recv = c.cls)),
          (SELECT min(rank) FROM r WHERE r.cls = c.pcls AND r.mth = c.pmth AND r.callee = c.mth), (SELECT min(rank) FROM r WHERE r.callee = c.mth), 1000000000) AS rank FROM c""",
)
def call_rank_lookup(t: Tables) -> DataFrame:
    o, k = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    cells = t.orders.select("o_orderkey", text("cls", o % 7).alias("pcls"), text("m", o % 20).alias("pmth"), text("cls", k % 5).alias("cls"), text("m", k % 40).alias("mth"))
    return lookup.call_rank(cells, call_ranks(t)).select("o_orderkey", "rank")


@query(
    "reordered_flow",
    """WITH r AS (SELECT n_nationkey, n_regionkey, row_number() OVER (ORDER BY n_name, n_nationkey) AS nr FROM nation), c AS (SELECT o_orderkey AS id, n_regionkey, nr, c_acctbal, c_custkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN r ON c_nationkey = n_nationkey),
       g AS (SELECT n_regionkey, min(nr) AS gr FROM r GROUP BY 1)
       SELECT id, row_number() OVER (ORDER BY gr, nr, c_acctbal, c_custkey, id) - 1 AS pos FROM c JOIN g USING (n_regionkey)""",
)
def reordered_flow(t: Tables) -> DataFrame:
    """Roots by declaration rank, below them children by call rank, level by level: one sort by the array of ranks, ties in
    the old order. The flow's sheet of a workbook is written anew, its other sheets stay."""
    nations = ordering.global_rank(t.nation.select("n_nationkey", "n_name", "n_regionkey"), ["n_name", "n_nationkey"], "nr", 1)
    groups = nations.groupBy("n_regionkey").agg(F.min("nr").alias("gr"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(nations.join(groups, "n_regionkey"), F.col("c_nationkey") == F.col("n_nationkey"))
    ranks = F.array(F.col("gr").cast("double"), F.col("nr").cast("double"), F.col("c_acctbal"), F.col("c_custkey").cast("double"))
    keyed = rows.select(F.col("o_orderkey").alias("id"), ranks.alias("ranks"))
    book = new_path(t.spark, "book")
    write_sheets(book, {"Flow": keyed.select("id"), "Methods": t.nodes})
    write_sheets(book, {"Flow": ordering.global_rank(keyed, ["ranks", "id"], "pos").select("id", "pos")}, "update")
    require_columns(read_sheet(t.spark, book, "Methods"), ["cls", "mth", "loc"])
    return read_sheet(t.spark, book, "Flow")


@query("path_rank_sort", """SELECT o_orderkey AS id, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey % 4, c_custkey % 10, o_orderkey) - 1 AS pos FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def path_rank_sort(t: Tables) -> DataFrame:
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    path = F.array(F.col("n_nationkey").cast("long"), F.col("c_custkey"))
    ranks = F.transform(path, lambda x, k: F.when(k == 0, x % 4).otherwise(x % 10))
    keyed = rows.select("n_regionkey", ranks.alias("ranks"), F.col("o_orderkey").alias("id"))
    return ordering.rank_within(keyed, ["n_regionkey"], ["ranks", "id"], "pos").select("id", "pos")


# --- chunks -------------------------------------------------------------------------------------------------------------


@query("chunk_edges", "SELECT parent, CAST(child AS VARCHAR) AS children, entity FROM {chunk_edges} WHERE child IS NOT NULL")
def chunk_edges(t: Tables) -> DataFrame:
    return t.chunk_edges.where("child IS NOT NULL").groupBy("parent").agg(F.array_join(ordering.ordered_list(F.col("child").cast("string"), ["child"]), ", ").alias("children"), F.min("entity").alias("entity"))


@query("top_parents", "SELECT DISTINCT l_orderkey AS chunk FROM lineitem WHERE l_orderkey NOT IN (SELECT child FROM {chunk_edges} WHERE child IS NOT NULL)")
def top_parents(t: Tables) -> DataFrame:
    return graph.top_parents(t.tokens.select("chunk"), t.chunk_edges)


@query(
    "chunk_update",
    r"""WITH p AS (SELECT *, trim(split_part(token, ' no_of_lines', 1)) AS name, coalesce(try_cast(trim(split_part(token, ':', 2)) AS BIGINT), 0) AS loc FROM {tokens} WHERE NOT regexp_matches(token, '^C[0-9]{3}_.+')),
        e AS (SELECT * FROM {chunk_edges} WHERE child IS NOT NULL), gone AS (SELECT DISTINCT e.parent AS chunk, p.name FROM e JOIN p ON p.chunk = e.child),
        k AS (SELECT p.* FROM p ANTI JOIN gone ON gone.chunk = p.chunk AND gone.name = p.name),
        a AS (SELECT chunk, string_agg(name || ' no_of_lines : ' || CASE WHEN loc = 0 THEN 'Nil' ELSE CAST(loc AS VARCHAR) END, ', ' ORDER BY line, part, supp, quantity, price) AS methods, CAST(sum(CASE WHEN regexp_matches(name, '^(G|GRP|GROUP)[-_]?[0-9]+') THEN 0 ELSE loc END) AS BIGINT) AS s FROM k GROUP BY 1),
        c AS (SELECT parent AS chunk, string_agg(CAST(child AS VARCHAR), ', ' ORDER BY child) AS d, count(*) AS n FROM e GROUP BY 1)
        SELECT t.chunk, coalesce(methods, '') AS methods, coalesce(s, 0) AS clear_code_sum, coalesce(d, '') AS direct_children, coalesce(n, 0) AS descendants_count FROM (SELECT DISTINCT chunk FROM {tokens}) t LEFT JOIN a USING (chunk) LEFT JOIN c USING (chunk)""",
)
def chunk_update(t: Tables) -> DataFrame:
    return graph.update_chunks(t.tokens, t.chunk_edges, ["line", "part", "supp", "quantity", "price"])
