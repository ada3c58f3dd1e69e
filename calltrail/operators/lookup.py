"""Lookups: type resolution, inheritance, field and call chains, as-of and rank joins.

All are equi-joins, with a residual condition where the rule needs one; Catalyst picks broadcast or sort-merge by size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.operators.shared import materialize


def variable_types(types: DataFrame, keys: list[str]) -> DataFrame:
    """keys, var_type: the first type by position, unless that is a collection and a later one is not."""
    collection = F.col("type").rlike(r"^(List|Set|Map|Collection|Queue|Deque)\b")
    return types.groupBy(*keys).agg(F.min_by("type", F.struct(collection.alias("c"), "pos")).alias("var_type"))


def return_types(returns: DataFrame) -> DataFrame:
    """cls, method, ret: the last declaration wins."""
    return returns.groupBy("cls", "method").agg(F.max_by("ret", "pos").alias("ret"))


def lookup_type(calls: DataFrame, base: Column, types: DataFrame, classes: DataFrame, impls: DataFrame | None = None) -> DataFrame:
    """calls with resolved: the caller's class for own roots; else the variable's type in the file, anywhere, a known
    class of that name (capitalised), its implementation, or the text itself.

    types: file_name, var, type, pos. classes: cls. impls: iface, impl. Columns of calls: file_name, class_interface_name.
    """
    scoped = variable_types(types.select("file_name", F.lower("var").alias("__v"), "type", "pos"), ["file_name", "__v"]).withColumnRenamed("var_type", "__scoped")
    anywhere = variable_types(types.select(F.lower("var").alias("__v"), "type", "pos"), ["__v"]).withColumnRenamed("var_type", "__global")
    own = calls.withColumn("__b", F.trim(base)).withColumn("__v", F.lower("__b"))
    out = own.join(scoped, ["file_name", "__v"], "left").join(anywhere, "__v", "left")
    plain = T.strip_generics(F.col("__b"))
    out = out.withColumn("__cap", T.upper_first(plain)).join(classes.select(F.col("cls").alias("__cap"), F.lit(True).alias("__known")).distinct(), "__cap", "left")
    text = plain
    if impls is not None:
        out = out.join(impls.select(F.col("iface").alias("__i"), "impl"), plain == F.col("__i"), "left")
        text = F.coalesce(F.col("impl"), plain)
    own_class = T.strip_generics(F.col("class_interface_name"))
    found = (
        F.when(F.coalesce(F.col("__b"), F.lit("")) == "", own_class)
        .when(F.col("__v").isin(*T.SELF_ROOTS), own_class)
        .otherwise(F.coalesce(T.strip_generics(F.col("__scoped")), T.strip_generics(F.col("__global")), F.when(F.col("__known"), F.col("__cap")), text))
    )
    return out.withColumn("resolved", found).select(*calls.columns, "resolved")


def substitute_impl(rows: DataFrame, cls: str, methods: DataFrame, suffix: str = "Impl") -> DataFrame:
    """rows with target: the class, or its implementation (by suffix) where that has methods and the class has none. methods: cls."""
    declared = methods.select(F.col("cls").alias("__d")).distinct()
    own = rows.withColumn("__i", F.concat(cls, F.lit(suffix)))
    out = own.join(declared.withColumn("__own", F.lit(True)), F.col(cls) == F.col("__d"), "left").drop("__d")
    out = out.join(declared.withColumn("__has", F.lit(True)), F.col("__i") == F.col("__d"), "left")
    return out.withColumn("target", F.when(F.col("__has") & F.col("__own").isNull(), F.col("__i")).otherwise(F.col(cls))).drop("__d", "__i", "__own", "__has")


def best_overload(wanted: DataFrame, methods: DataFrame) -> DataFrame:
    """wanted with loc of the overload it means: of equal arity where there is one, there with most equal types, then most lines.

    Types that are not as many as asked for are worse than any. wanted: cls, mth, want (types); methods: cls, mth, types,
    loc. Rows without a method of that name go.
    """
    own = wanted.withColumn("__want", F.transform(F.coalesce("want", F.array().cast("array<string>")), T.normal_type))
    known = methods.select("cls", "mth", F.transform(F.coalesce("types", F.array().cast("array<string>")), T.normal_type).alias("__types"), "loc")
    equal = F.aggregate(F.zip_with("__types", "__want", lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, x: a + x)
    same = F.size("__types") == F.size("__want")
    score = F.struct(same.alias("arity"), F.when(same, equal).otherwise(F.lit(-1)).alias("types"), F.col("loc").alias("lines"))
    return own.join(known, ["cls", "mth"]).groupBy(*[F.col(f"`{c}`") for c in wanted.columns]).agg(F.max_by("loc", score).alias("loc"))


def ancestors(parents: DataFrame, classes: DataFrame) -> DataFrame:
    """cls, anc, depth: each class and what it extends, nearest first; a cycle ends where it would repeat.

    parents: cls, parent. A round climbs one step for all classes; the rounds are as many as the hierarchy is deep.
    """
    up = parents.select(F.col("cls").alias("anc"), "parent").distinct()
    frontier = materialize(classes.select("cls", F.col("cls").alias("anc"), F.lit(0).alias("depth")).distinct())
    found, depth = frontier, 0
    while True:
        depth += 1
        new = frontier.join(up, "anc").select("cls", F.col("parent").alias("anc"), F.lit(depth).alias("depth")).distinct()
        frontier = materialize(new.join(found, ["cls", "anc"], "left_anti"))
        if frontier.isEmpty():
            return found
        found = found.unionByName(frontier)


def owners(returns: DataFrame, parents: DataFrame) -> DataFrame:
    """cls, method, owner: the nearest class from cls upwards that declares the method. Classes that neither declare nor extend anything have no row."""
    declared = returns.select(F.col("cls").alias("anc"), "method").distinct()
    known = returns.select("cls").union(parents.select("cls")).distinct()
    return ancestors(parents, known).join(declared, "anc").groupBy("cls", "method").agg(F.min_by("anc", "depth").alias("owner"))


def inherited_owner(calls: DataFrame, cls: str, method: str, returns: DataFrame, parents: DataFrame) -> DataFrame:
    """calls with owner: where no class upwards declares the method, the class itself."""
    found = owners(returns, parents).select(F.col("cls").alias(cls), F.col("method").alias(method), F.col("owner").alias("__o"))
    return calls.join(found, [cls, method], "left").withColumn("owner", F.coalesce("__o", cls)).drop("__o")


def chain_steps(returns: DataFrame, parents: DataFrame) -> DataFrame:
    """cls, method, owner, next: for every class and method in reach, its owner and the class that the call returns.

    next is null where a chain ends: nothing returned, or an unknown method.
    """
    own = owners(returns, parents)
    ret = return_types(returns).select(F.col("cls").alias("owner"), "method", "ret")
    joined = own.join(ret, ["owner", "method"], "left")
    ends = F.lower("ret").isin("void", "<constructor>")
    return joined.select("cls", "method", "owner", F.when(~F.coalesce(ends, F.lit(True)), T.simple_type(F.col("ret"))).alias("next"))


def chain_segments(chains: DataFrame, steps: DataFrame) -> DataFrame:
    """id, pos, segment of chains (id, cls, methods): "Owner.method()" for each call until the returned class is unknown.

    A round resolves one position of all open chains; the rounds are as many as the longest chain has calls.
    """
    known = steps.select("cls", F.col("method").alias("__m"), "owner", "next")
    open_, out, pos = chains.select("id", "cls", "methods"), None, 0
    while True:
        method = F.get("methods", F.lit(pos))
        step = open_.where(F.size("methods") > pos).withColumn("__m", method).join(known, ["cls", "__m"], "left")
        segment = F.concat(F.coalesce("owner", "cls"), F.lit("."), F.col("__m"), F.lit("()"))
        done = materialize(step.select("id", F.lit(pos).alias("pos"), segment.alias("segment"), F.col("next").alias("cls"), "methods"))
        part = done.select("id", "pos", "segment")
        out = part if out is None else out.unionByName(part)
        open_, pos = done.where("cls IS NOT NULL").select("id", "cls", "methods"), pos + 1
        if open_.where(F.size("methods") > pos).isEmpty():
            return out


def external_bases(calls: DataFrame, base: Column, external: DataFrame, by_file: bool = False) -> DataFrame:
    """calls without those on an external class; calls without a base stay. external: cls (and file_name if by_file)."""
    keys = ["__base", "file_name"] if by_file else ["__base"]
    return calls.withColumn("__base", base).join(external.withColumnRenamed("cls", "__base"), keys, "left_anti").drop("__base")


def drop_object_twins(calls: DataFrame, keys: list[str], call: str) -> DataFrame:
    """calls without obj.m rows whose Obj.m stands beside them under the same keys; null calls stay."""
    upper = calls.where(T.starts_upper(F.col(call))).select(*keys, F.col(call).alias("__twin")).distinct()
    own = calls.withColumn("__twin", F.when(~T.starts_upper(F.col(call)), T.upper_first(F.col(call))))
    return own.join(upper, [*keys, "__twin"], "left_anti").drop("__twin")


def as_of_backward(left: DataFrame, right: DataFrame, by: str, left_pos: str, right_pos: str, value: str) -> DataFrame:
    """left with value of the last right row at or before its position, by one pass over both in order.

    A union and a window keep every row once; there is no join of all pairs within a key. On equal positions the right row comes first.
    """
    from pyspark.sql import Window

    names = left.columns
    a = left.select(*names, F.col(left_pos).alias("__p"), F.lit(1).alias("__side"), F.lit(None).cast(right.schema[value].dataType).alias("__value"))
    b = right.select(*[(F.col(by) if c == by else F.lit(None).cast(left.schema[c].dataType)).alias(c) for c in names], F.col(right_pos).alias("__p"), F.lit(0).alias("__side"), F.col(value).alias("__value"))
    w = Window.partitionBy(by).orderBy("__p", "__side").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("found", F.last("__value", ignorenulls=True).over(w)).where("__side = 1").select(*names, "found")


def as_of_forward(left: DataFrame, right: DataFrame, by: str, left_pos: str, right_pos: str, value: str) -> DataFrame:
    """left with value of the first right row at or after its position. The pass goes from the end, so each row is seen once."""
    from pyspark.sql import Window

    names = left.columns
    a = left.select(*names, F.col(left_pos).alias("__p"), F.lit(0).alias("__side"), F.lit(None).cast(right.schema[value].dataType).alias("__value"))
    b = right.select(*[(F.col(by) if c == by else F.lit(None).cast(left.schema[c].dataType)).alias(c) for c in names], F.col(right_pos).alias("__p"), F.lit(1).alias("__side"), F.col(value).alias("__value"))
    w = Window.partitionBy(by).orderBy(F.desc("__p"), F.desc("__side")).rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("found", F.last("__value", ignorenulls=True).over(w)).where("__side = 0").select(*names, "found")


def prefix_join(keys: DataFrame, prefixes: DataFrame) -> DataFrame:
    """key, prefix: key equals a prefix, or goes on with a dot behind it.

    Each key is cut at its dots into the prefixes it could have, so this is an equi-join and never a pairing of all rows.
    """
    parts = F.split("key", r"\.")
    cut = keys.withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))))
    return cut.join(prefixes, "prefix").select("key", "prefix")


def rank_with_fallback(cells: DataFrame, ranks: DataFrame) -> DataFrame:
    """cells (cls, mth) with rank: of the pair, else the smallest of the method's name, else NO_RANK. ranks: cls, mth, rank."""
    by_name = ranks.groupBy("mth").agg(F.min("rank").alias("__any"))
    exact = ranks.groupBy("cls", "mth").agg(F.min("rank").alias("__exact"))
    return cells.join(exact, ["cls", "mth"], "left").join(by_name, "mth", "left").withColumn("rank", F.coalesce("__exact", "__any", F.lit(T.NO_RANK)).cast("long")).drop("__exact", "__any")


def call_rank(cells: DataFrame, ranks: DataFrame) -> DataFrame:
    """cells (pcls, pmth, cls, mth) with rank: under the parent with an equal or missing receiver, under the parent by
    name, by name anywhere, else NO_RANK. ranks: cls, mth, recv, callee, rank (of the method cls.mth). Ranks under a parent
    are as many as the calls, and meet their cells by sorting."""
    own = ranks.select(F.col("cls").alias("pcls"), F.col("mth").alias("pmth"), "recv", F.col("callee").alias("mth"), "rank")
    named = own.where("recv IS NOT NULL").groupBy("pcls", "pmth", "mth", F.col("recv").alias("cls")).agg(F.min("rank").alias("__r1")).hint("merge")
    free = own.where("recv IS NULL").groupBy("pcls", "pmth", "mth").agg(F.min("rank").alias("__r0")).hint("merge")
    any_recv = own.groupBy("pcls", "pmth", "mth").agg(F.min("rank").alias("__r2")).hint("merge")
    anywhere = own.groupBy("mth").agg(F.min("rank").alias("__r3"))
    out = cells.join(named, ["pcls", "pmth", "mth", "cls"], "left").join(free, ["pcls", "pmth", "mth"], "left").join(any_recv, ["pcls", "pmth", "mth"], "left").join(anywhere, "mth", "left")
    return out.withColumn("rank", F.coalesce(F.least("__r0", "__r1"), "__r2", "__r3", F.lit(T.NO_RANK)).cast("long")).drop("__r0", "__r1", "__r2", "__r3")


def resolve_unqualified(callers: DataFrame, methods: DataFrame) -> DataFrame:
    """caller, target of calls by bare name: own private methods, public methods of classes, overriding methods of
    implementations, and interface methods. callers: caller (Class.method), name. methods: cls, mth, type, access, annotations."""
    m = methods.select(F.lower("mth").alias("__n"), F.concat_ws(".", "cls", "mth").alias("target"), "type", "access", "annotations").distinct()
    joined = callers.withColumn("__n", F.lower("name")).join(m, "__n")
    private = (F.col("type") == "class") & (F.col("access") == "private") & (F.lower("caller") == F.lower("target"))
    public = (F.col("type") == "class") & (F.col("access") == "public")
    override = (F.col("type") == "class_implements_interface") & F.coalesce(F.col("annotations").contains("@Override"), F.lit(False))
    return joined.where(private | public | override | (F.col("type") == "interface")).select("caller", "name", "target").distinct()
