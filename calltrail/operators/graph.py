"""Graph operators: reachability, closures, simple paths, and chunk updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.operators.ordering import global_rank, ordered_list
from calltrail.operators.shared import discard, materialize

#: Edges that a round of simple_paths() goes before its rows are written, and a round of a closure before it looks at what was seen.
STEPS = 4
#: Rounds after which what has been found is written as one table again.
COMPACT = 8


def reachable(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """node, depth: everything reachable from seeds (node), with the number of steps. edges: src, dst.

    One join and one anti-join a round, on the frontier; edges and each round's nodes are written tables, and what has been
    found is put together again every few rounds, so neither plans nor the number of tables grow.
    """
    step = materialize(edges.select("src", "dst").distinct())
    frontier = materialize(seeds.select("node", F.lit(0).alias("depth")).distinct())
    found, parts, depth = frontier, [frontier], 0
    while True:
        depth += 1
        new = frontier.join(step, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct().join(found, "node", "left_anti")
        frontier = materialize(new.select("node", F.lit(depth).alias("depth")))
        if frontier.isEmpty():
            return found
        found, parts = _grown(found, parts, frontier, depth)


def _grown(found: DataFrame, parts: list[DataFrame], new: DataFrame, round_: int) -> tuple[DataFrame, list[DataFrame]]:
    """found with a round's table; every COMPACT rounds as one table, after which those before it are deleted."""
    found, parts = found.unionByName(new), [*parts, new]
    if round_ % COMPACT:
        return found, parts
    whole = materialize(found)
    discard(*parts[:-1])  # the round's own is the frontier
    return whole, [new, whole]


def discovery(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """node, round, number: in the order of a queue that takes seeds in their order, and what each node refers to in the
    order of its references, each node once. edges: src, dst, place (order within src); seeds: node, place.

    A round's new nodes are ordered by their first parent's number and the reference's place there, and numbered from
    where the round before ended, over ranges; so no node needs to know more than its frontier.
    """
    step = materialize(edges.groupBy("src", "dst").agg(F.min("place").alias("place")))
    first = seeds.groupBy("node").agg(F.min("place").alias("place"))
    frontier = materialize(global_rank(first, ["place", "node"], "number").select("node", F.lit(0).alias("round"), "number"))
    found, parts, round_, n = frontier, [frontier], 0, frontier.count()
    while True:
        round_ += 1
        reached = frontier.join(step, F.col("node") == F.col("src")).groupBy("dst").agg(F.min(F.struct("number", "place")).alias("by"))
        new = reached.withColumnRenamed("dst", "node").join(found, "node", "left_anti").select("node", F.col("by.number").alias("parent"), F.col("by.place").alias("place"))
        frontier = materialize(global_rank(new, ["parent", "place", "node"], "number", n).select("node", F.lit(round_).alias("round"), "number"))
        size = frontier.count()
        if not size:
            return found
        n += size
        found, parts = _grown(found, parts, frontier, round_)


def closure(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """start, src, dst: every edge that a walk from start visits. edges: src, dst; starts: start."""
    step = materialize(edges.select("src", "dst").distinct())
    return _walked(step, starts).join(step, F.col("node") == F.col("src")).select("start", "src", "dst")


def _walked(step: DataFrame, starts: DataFrame) -> DataFrame:
    """start, node: every node that a walk from start visits, itself too.

    A round goes STEPS steps, each a written table, before what it found meets what was seen: that is the large table, so
    it is read once in STEPS steps. `at` is the step of its round in which a node was first found; all but the last step's
    nodes have been walked on from in that round, so those alone are the next round's frontier.
    """
    last = STEPS - 1
    frontier = materialize(starts.select("start", F.col("start").alias("node"), F.lit(last).alias("at")).distinct())
    seen, parts, round_ = frontier, [frontier], 0
    while True:
        round_ += 1
        ahead, steps = frontier.where(F.col("at") == last), []
        for k in range(STEPS):
            ahead = materialize(ahead.join(step, F.col("node") == F.col("src")).select("start", F.col("dst").alias("node"), F.lit(k).alias("at")).distinct())
            steps.append(ahead)
            if ahead.isEmpty():
                break
        found = reduce(DataFrame.unionByName, steps).groupBy("start", "node").agg(F.min("at").alias("at"))
        frontier = materialize(found.join(seen, ["start", "node"], "left_anti"))
        discard(*steps)
        if frontier.isEmpty():
            return seen.select("start", "node")
        seen, parts = _grown(seen, parts, frontier, round_)


def method_name(call: Column) -> Column:
    """What stands behind the last dot of a call, without its brackets."""
    return F.substring_index(F.substring_index(call, "(", 1), ".", -1)


def closure_by_name(methods: DataFrame, calls: DataFrame, starts: DataFrame) -> DataFrame:
    """start, file, current, call: the calls that a walk from each start meets, where a call leads to the first type that
    owns a method of its name, whatever type it names itself.

    Current is the start, or a call met on the way. A method without calls gives one row with an empty call; a name that
    nobody owns gives one of file `Unknown`. Starts of one name share one walk over names: what lies behind them is the
    same. Rows are as many as starts times what they reach, so starts bound them.

    methods: cls, mth, file, at (order of types); calls: cls, mth, call; starts: start.
    """
    owner = methods.groupBy("mth").agg(F.min_by(F.struct("cls", "file"), F.struct("at", "cls")).alias("o")).select(F.col("o.cls").alias("cls"), "mth", F.col("o.file").alias("file"))
    own = materialize(owner.join(calls.where("call <> ''").select("cls", "mth", "call").distinct(), ["cls", "mth"], "left").select("mth", "file", "call"))
    step = materialize(own.where("call IS NOT NULL").select(F.col("mth").alias("src"), method_name(F.col("call")).alias("dst")).distinct())
    asked = materialize(starts.select("start", method_name(F.col("start")).alias("name")).distinct())
    walked = _walked(step, asked.select(F.col("name").alias("start")).distinct()).withColumnRenamed("start", "name")
    met = walked.join(own.where("call IS NOT NULL").select(F.col("mth").alias("node"), F.col("call").alias("current")), "node").select("name", "current")
    current = asked.join(met, "name").select("start", "current").unionByName(asked.select("start", F.col("start").alias("current"))).distinct()
    rows = current.withColumn("mth", method_name(F.col("current"))).join(own, "mth", "left")
    return rows.select("start", F.coalesce("file", F.lit("Unknown")).alias("file"), "current", F.coalesce("call", F.lit("")).alias("call"))


def simple_paths(edges: DataFrame, roots: DataFrame, pruned: DataFrame | None = None, max_depth: int | None = None) -> DataFrame:
    """root, path: all paths from roots to leaves; a node that repeats ends its path there, and so does max_depth.

    Pruned nodes vanish with what is below; a root that is itself pruned has no path. edges: src, dst; roots, pruned: node.
    A round extends all open paths by STEPS edges and writes them, so there is no limit on rows and a lost executor
    costs one round. Paths that have ended pass through a round's joins without a partner, spread by their last node.
    """
    own, start = edges.select("src", "dst").distinct(), roots.select("node").distinct()
    if pruned is not None:
        own = own.join(pruned.withColumnRenamed("node", "dst"), "dst", "left_anti").join(pruned.withColumnRenamed("node", "src"), "src", "left_anti")
        start = start.join(pruned, "node", "left_anti")
    own = materialize(own)
    open_ = start.select(F.col("node").alias("root"), "node", F.array("node").alias("path"), F.lit(False).alias("done"))
    ended, size = None, 1
    while True:
        for _ in range(STEPS):
            if max_depth is not None and size >= max_depth:
                open_ = open_.withColumn("done", F.lit(True))
                break
            dst, done = F.col("dst"), F.col("done")
            step = open_.join(own, (F.col("node") == F.col("src")) & ~done, "left")
            loop = F.coalesce(F.array_contains("path", dst), F.lit(False))
            open_ = step.select("root", F.coalesce(dst, "node").alias("node"), F.when(dst.isNull(), F.col("path")).otherwise(F.array_append("path", dst)).alias("path"), (done | dst.isNull() | loop).alias("done"))
            size += 1
        rows = materialize(open_)
        part = rows.where("done").select("root", "path")
        ended = part if ended is None else ended.unionAll(part)
        open_ = rows.where("NOT done")
        if open_.isEmpty():
            return ended


def resolved_edges(calls: DataFrame, methods: DataFrame) -> DataFrame:
    """src, dst (Class.method, in lower case) of calls (caller, callee): a qualified callee as it is; a bare one goes to
    all methods that it may mean (lookup.resolve_unqualified), and where there is none to the caller's own class.

    Edges are resolved before any path is walked. methods: cls, mth, type, access, annotations.
    """
    from calltrail.operators.lookup import resolve_unqualified

    own = calls.select("caller", F.trim(F.substring_index("callee", "(", 1)).alias("callee")).where("callee <> ''").distinct()
    qualified = own.where(F.col("callee").contains(".")).select("caller", F.col("callee").alias("target"))
    bare = own.where(~F.col("callee").contains(".")).withColumnRenamed("callee", "name")
    found = bare.join(resolve_unqualified(bare, methods), ["caller", "name"], "left")
    target = F.coalesce("target", F.concat(F.substring_index("caller", ".", 1), F.lit("."), "name"))
    return qualified.unionByName(found.select("caller", target.alias("target"))).select(F.lower("caller").alias("src"), F.lower("target").alias("dst")).distinct()


def flow_edges(calls: DataFrame, methods: DataFrame, lines: DataFrame, pruned: DataFrame | None = None, suffix: str = "Impl") -> tuple[DataFrame, DataFrame]:
    """(edges, labels): src and dst as labels "Class.method no_of_lines : n", and the label of every node, all rewriting
    done before a path is walked.

    Calls are resolved by resolved_edges(); a callee whose class has an implementation (by suffix) with that method is
    that one; classes of `pruned` (cls) vanish as callers and callees; a callee without a row is a leaf. Lines of nodes
    without any are 0. Names are compared in lower case and shown as declared, or as called where nobody declares them.

    calls: caller, callee; methods: cls, mth, type, access, annotations; lines: cls, mth, loc.
    """
    known = methods.groupBy(F.lower("cls").alias("c"), F.lower("mth").alias("m")).agg(F.min(F.struct("cls", "mth")).alias("shown"))
    known = materialize(known.select(F.concat_ws(".", "c", "m").alias("node"), F.concat_ws(".", "shown.cls", "shown.mth").alias("name")))
    named = calls.select(F.trim(F.substring_index("callee", "(", 1)).alias("name")).where(F.col("name").contains(".")).unionByName(calls.select(F.col("caller").alias("name")))
    said = named.groupBy(F.lower("name").alias("node")).agg(F.min("name").alias("said"))
    edges = resolved_edges(calls, methods)
    cut = F.length("dst") - F.length(F.substring_index("dst", ".", -1)) - 1
    edges = edges.withColumn("impl", F.concat(F.substring(F.col("dst"), F.lit(1), cut), F.lit(suffix.lower()), F.lit("."), F.substring_index("dst", ".", -1)))
    edges = edges.join(known.select(F.col("node").alias("impl"), F.lit(True).alias("there")), "impl", "left").select("src", F.when(F.col("there"), F.col("impl")).otherwise(F.col("dst")).alias("dst")).distinct()
    if pruned is not None:
        gone = pruned.select(F.lower("cls").alias("cls")).distinct()
        for end in ("src", "dst"):
            edges = edges.withColumn("cls", F.substring_index(end, ".", 1)).join(gone, "cls", "left_anti").drop("cls")
    edges = materialize(edges)
    nodes = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).unionByName(known.select("node")).distinct()
    loc = lines.groupBy(F.concat_ws(".", F.lower("cls"), F.lower("mth")).alias("node")).agg(F.max("loc").alias("loc"))
    shown = nodes.join(known, "node", "left").join(said, "node", "left").join(loc, "node", "left")
    labels = materialize(shown.select("node", F.concat(F.coalesce("name", "said", "node"), F.lit(" no_of_lines : "), F.coalesce("loc", F.lit(0)).cast("string")).alias("label")))
    out = edges
    for end in ("src", "dst"):
        out = out.join(labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label")), end)
    return out.select(F.col("src_label").alias("src"), F.col("dst_label").alias("dst")), labels


def cells(paths: DataFrame, ids: list[str]) -> DataFrame:
    """ids, level (from 1), node: the long form of paths."""
    return paths.select(*ids, F.posexplode("path").alias("__l", "node")).select(*ids, (F.col("__l") + 1).alias("level"), "node")


def wide(paths: DataFrame, ids: list[str], width: int) -> DataFrame:
    """ids, Level_1..Level_width, filled up with empty texts."""
    return paths.select(*ids, *[F.coalesce(F.get("path", F.lit(k)).cast("string"), F.lit("")).alias(f"Level_{k + 1}") for k in range(width)])


def top_parents(chunks: DataFrame, edges: DataFrame) -> DataFrame:
    """chunk: those that are nobody's child."""
    return chunks.select("chunk").distinct().join(edges.select(F.col("child").alias("chunk")).where("chunk IS NOT NULL").distinct(), "chunk", "left_anti")


def update_chunks(tokens: DataFrame, edges: DataFrame, order: list[str]) -> DataFrame:
    """chunk, methods, clear_code_sum, direct_children, descendants_count of each chunk.

    Methods that a child holds go, chunk ids go too, the rest keep their order; groups do not count into the sum.
    tokens: chunk, token and the order columns; edges: parent, child, entity, a null child being none.
    """
    rows = materialize(tokens.withColumn("t", T.parse_token(F.col("token"))).select("chunk", *order, F.col("t.kind").alias("kind"), F.col("t.name").alias("name"), F.col("t.loc").alias("loc")))
    parsed = rows.where("kind = 'method'")
    links = edges.where("child IS NOT NULL").select(F.col("parent").alias("chunk"), "child", "entity")
    lower = links.join(parsed.select(F.col("chunk").alias("child"), "name"), "child").select("chunk", "name").distinct()
    left = parsed.join(lower, ["chunk", "name"], "left_anti")
    counted: Column = F.when(~T.is_group_id(F.col("name")), F.coalesce("loc", F.lit(0))).otherwise(F.lit(0))
    kept = left.groupBy("chunk").agg(F.array_join(ordered_list(T.format_token(F.col("name"), F.col("loc")), order), ", ").alias("methods"), F.sum(counted).alias("clear_code_sum"))
    children = links.groupBy("chunk").agg(F.array_join(ordered_list(F.col("child").cast("string"), ["child"]), ", ").alias("direct_children"), F.count("*").alias("descendants_count"))
    out = rows.select("chunk").distinct().join(kept, "chunk", "left").join(children, "chunk", "left")
    zero = F.lit(0).cast("long")
    return out.select("chunk", F.coalesce("methods", F.lit("")).alias("methods"), F.coalesce("clear_code_sum", zero).alias("clear_code_sum"), F.coalesce("direct_children", F.lit("")).alias("direct_children"), F.coalesce("descendants_count", zero).alias("descendants_count"))
