"""Resolution of calls by joins: chains and the names that they claim, import scopes, and folds along field chains.

Rows come from the scanner or from patterns over stripped method bodies; who means what is decided here, in equi-joins on
a method's body, its class, or its file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.operators import lookup
from calltrail.operators.shared import materialize

# Patterns of chains, of what is called on a result, and words that start no chain.
CHAIN = r"\b[a-zA-Z_]\w*(?:\s*\([^()]*\))?(?:\s*\.\s*[a-zA-Z_]\w*\s*\([^()]*\))+"
ON_RESULT = r"\b[A-Za-z_]\w*\s*\([^()]*\)\s*\.\s*([A-Za-z_]\w*)\s*\("
CHAIN_ON_RESULT = r"\b[A-Za-z_]\w*\s*\([^()]*\)(?:\s*\.\s*[A-Za-z_]\w*\s*\([^()]*\))+"
SEGMENT = r"\.\s*([A-Za-z_]\w*)\s*\("
CHAIN_KEYWORDS = tuple(dict.fromkeys([*T.SELF_ROOTS, *T.SKIP_WORDS["calls"]]))


def _all(text: Column | str, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _first(text: str, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def chain_calls(bodies: DataFrame, variables: DataFrame, fields: DataFrame, qualified: DataFrame) -> DataFrame:
    """body, call, how of the chains in method bodies, in two passes.

    First the chains: a root that is a field of the class or a variable of the body gives way to its type (`rewritten`),
    a capitalised root stays (`class`), a chain on a constructor becomes a call of its type for each segment (`ctor`), and
    any other root drops the chain. Segments of `ctor` claim their names in their body. Then the bare names called on a
    result (`dynamic`), without those that are claimed, and without those that qualified calls of the body name already.

    bodies: body, cls, source (without comments and literals); variables: body, name, type; fields: cls, name, type;
    qualified: body, mth. A field goes before a variable of its name. Null sources have no rows.
    """
    own = materialize(bodies.select("body", "cls", "source"))
    chains = own.select("body", "cls", F.explode(F.array_distinct(_all("source", CHAIN, 0))).alias("chain")).withColumn("chain", F.trim("chain"))
    chains = chains.withColumn("root", _first("chain", r"^([A-Za-z_]\w*)\.")).withColumn("made", F.when(F.col("root").isNull(), _first("chain", r"^([A-Za-z_]\w*)\s*\(")))
    types = variables.groupBy("body", F.col("name").alias("root")).agg(F.first("type").alias("local")).hint("merge")
    members = fields.groupBy("cls", F.col("name").alias("root")).agg(F.first("type").alias("member")).hint("merge")
    rooted = chains.where(F.col("root").isNotNull() & ~F.col("root").isin(*CHAIN_KEYWORDS)).join(types, ["body", "root"], "left").join(members, ["cls", "root"], "left")
    type_ = T.clean_type(F.coalesce("member", "local"))
    rest = F.expr("substr(chain, length(root) + 1)")
    kept = rooted.select("body", F.when(type_.isNotNull(), F.concat(type_, rest)).when(F.col("root").rlike("^[A-Z]"), F.col("chain")).alias("call"), F.when(type_.isNotNull(), "rewritten").otherwise("class").alias("how")).where("call IS NOT NULL")
    made = chains.where(F.col("made").isNotNull() & ~F.col("made").isin(*CHAIN_KEYWORDS)).select("body", "made", F.explode(_all("chain", SEGMENT, 1)).alias("mth"))
    made = materialize(made.distinct())
    last = F.transform(_all("source", CHAIN_ON_RESULT, 0), lambda c: F.element_at(_all(c, SEGMENT, 1), -1))
    names = own.select("body", F.explode(F.array_distinct(F.concat(_all("source", ON_RESULT, 1), last))).alias("mth"))
    bare = names.join(made.select("body", "mth").unionByName(qualified.select("body", "mth")).distinct().hint("merge"), ["body", "mth"], "left_anti")
    calls = kept.unionByName(made.select("body", F.concat("made", F.lit("."), "mth", F.lit("()")).alias("call"), F.lit("ctor").alias("how")))
    return calls.unionByName(bare.select("body", F.concat("mth", F.lit("()")).alias("call"), F.lit("dynamic").alias("how"))).distinct()


# --- call sites -------------------------------------------------------------------------------------------------------


def resolved_calls(rows: DataFrame, include_unqualified: bool = True) -> DataFrame:
    """Call rows of call sites, their roots typed by joins; call rows among `rows` stay as they are.

    A site is the names of an expression. Its root is a local or parameter of the method, else a field of its class, else
    of the class around an anonymous one, else its own text; after `this.` it is a field. type: `ctor` and `throw` (X.X()), `sibling` (bare, or behind this: the class's own; bare ones only where
    asked for), `qualified` and `this_field` (the first call on a root), `chain` (all calls on it), `dynamic` (called on
    the result of a bare call). rows: of java.parse_sources(), as a table that may be read several times.
    """
    body = ["path", "cls", "mth", "ann"]
    local = rows.where("kind = 'var'").groupBy(*body, "name").agg(F.max_by("type", "pos").alias("__local")).hint("merge")  # as many as the bodies: written small, gathered large
    member = rows.where("kind = 'field'").groupBy("path", "cls", "name").agg(F.max_by("type", "pos").alias("__member"))
    w = F.split("name", r"\.")
    called = lambda x: x.endswith("()")
    own = rows.where("kind = 'site'").withColumn("__w", w).withColumn("__bare", (F.col("type") == "plain") & called(F.get("__w", F.lit(0)))).withColumn("__self", (F.col("type") == "plain") & F.get("__w", F.lit(0)).isin("this", "super"))
    own = own.withColumn("__at", F.when(F.col("__self") & ~called(F.coalesce(F.get("__w", F.lit(1)), F.lit("()"))), 1).otherwise(0)).withColumn("__root", F.get("__w", F.col("__at")))
    typed = own.join(local.withColumnRenamed("name", "__root"), [*body, "__root"], "left").join(member.withColumnRenamed("name", "__root").hint("merge"), ["path", "cls", "__root"], "left")
    around = member.select("path", F.col("cls").alias("__around"), F.col("name").alias("__root"), F.col("__member").alias("__outer"))
    typed = typed.withColumn("__around", F.when(F.col("cls").contains("$"), F.substring_index("cls", "$", 1))).join(around.hint("merge"), ["path", "__around", "__root"], "left")
    field = F.coalesce("__member", "__outer", "__root")
    known = F.when(~F.col("type").isin("plain", "index"), F.col("__root")).when(F.col("__self") & (F.col("__at") == 0), F.col("cls")).when(F.col("__self"), field).otherwise(F.coalesce("__local", field))
    root = F.regexp_replace(known, "<.*>", "")
    root = F.when(F.col("type") == "index", F.replace(root, F.lit("[]"), F.lit(""))).otherwise(root)
    rest = F.expr("slice(__w, __at + 2, size(__w))")
    typed = typed.withColumn("__rest", rest).withColumn("__calls", F.filter("__rest", called))
    first, whole = (F.array_join(F.concat(F.array(root), x), ".") for x in (F.slice("__rest", F.lit(1), F.array_position("__rest", F.get("__calls", F.lit(0))).cast("int")), F.col("__rest")))
    none = F.array().cast("array<struct<name:string,type:string>>")

    def one(name: Column, how: Column | str) -> Column:
        return F.array(F.struct(name.alias("name"), (F.lit(how) if isinstance(how, str) else how).alias("type")))

    chain = F.when(F.size("__calls") > 1, one(whole, "chain")).otherwise(none)
    how = F.when(F.col("__self"), F.when(F.col("__at") == 1, "this_field").otherwise("sibling")).otherwise("qualified")
    bare = one(F.concat("cls", F.lit("."), F.get("__w", F.lit(0))), "sibling") if include_unqualified else none
    found = (
        F.when(F.col("type").isin("new", "throw"), one(F.concat("__root", F.lit("."), "__root", F.lit("()")), F.when(F.col("type") == "throw", "throw").otherwise("ctor")))
        .when(F.col("__bare"), F.concat(bare, F.transform("__calls", lambda x: F.struct(x.alias("name"), F.lit("dynamic").alias("type")))))
        .otherwise(F.concat(one(first, how), chain))
    )
    calls = typed.select(*[c for c in rows.columns if c not in ("name", "type", "kind")], F.inline(found), F.lit("call").alias("kind"))
    return calls.select(*rows.columns).unionByName(rows.where("kind = 'call'"))


# --- import scopes ----------------------------------------------------------------------------------------------------

#: Rules in the order in which they are asked; the flag that a rule needs, if any.
KEEP_RULES = (("field", None), ("local_new", "accept_local_new_types"), ("parameter", "accept_parameter_types"), ("imported_type", None), ("imported_root", None), ("wildcard", None), ("same_package", "accept_same_package"), ("typed", None))
BARE_RULES = ("include_unqualified", "static_member", "static_wildcard")


def import_index(imports: DataFrame, own: str = "com.") -> DataFrame:
    """path, scope, name of imports below `own`: `type` with a simple name (static ones name their class too), `package`
    with the package of a wildcard, `static_member`, and `static_wildcard` with the class. imports: path, name, type."""
    parts = F.split("name", r"\.")
    simple, before = F.element_at(parts, -1), F.when(F.size(parts) > 1, F.element_at(parts, -2))
    kept = imports.where(F.col("name").startswith(own))
    kinds = (
        ("type = 'type'", "type", simple), ("type = 'wildcard'", "package", F.col("name")), ("type = 'static'", "static_member", simple),
        ("type = 'static'", "type", before), ("type = 'static_wildcard'", "static_wildcard", simple),
    )
    out = None
    for where, scope, name in kinds:
        part = kept.where(where).select("path", F.lit(scope).alias("scope"), name.alias("name"))
        out = part if out is None else out.unionByName(part)
    return out.where("name IS NOT NULL").distinct()


def keep_calls(calls: DataFrame, variables: DataFrame, fields: DataFrame, index: DataFrame, packages: DataFrame, flags: DataFrame, own: str = "com.") -> DataFrame:
    """calls with kept_by: the first rule that keeps the call, null where none does.

    Qualified calls go by KEEP_RULES, bare ones (null root) by BARE_RULES. A doubled variable name is the variable. calls:
    application, path, cls, body, root, mth. variables: body, name, type, how (param, new, or other). fields: cls, name.
    index: of import_index(). packages: path, package. flags: a row for each application with its four flags; an
    application without a row has them all off.

    What bodies and files hold grows with the calls and meets them by sorting: where it is made of few columns, Spark
    reckons it as small and would gather it in the driver.
    """
    half = F.when(F.length("root") % 2 == 0, F.expr("left(root, length(root) div 2)"))
    asked = calls.withColumn("__half", F.when(F.concat(half, half) == F.col("root"), half))
    var = variables.groupBy("body", "name").agg(F.max("type").alias("__t"), F.max(F.col("how") == "new").alias("__new"), F.max(F.col("how") == "param").alias("__param")).hint("merge")
    field = fields.select("cls", "name").distinct().withColumn("__field", F.lit(True)).hint("merge")
    out = asked
    for column, mark in (("root", ""), ("__half", "_half")):
        renamed = {c: f"{c}{mark}" for c in ("__t", "__new", "__param", "__field")}
        out = out.join(var.withColumnsRenamed(renamed).withColumnRenamed("name", column), ["body", column], "left").join(field.withColumnsRenamed(renamed).withColumnRenamed("name", column), ["cls", column], "left")
    plain = F.col("__t").isNotNull() | F.col("__field").isNotNull() | (F.col("__t_half").isNull() & F.col("__field_half").isNull())
    for c in ("__t", "__new", "__param", "__field"):
        out = out.withColumn(f"{c}_", F.when(plain, F.col(c)).otherwise(F.col(f"{c}_half")))
    out = out.withColumn("__name", F.when(plain, F.col("root")).otherwise(F.col("__half"))).withColumn("__type", T.clean_type(F.col("__t_")))
    types = index.where("scope = 'type'").select("path", "name")
    per_file = index.groupBy("path").agg(F.max(F.col("scope") == "package").alias("__wild"), F.max(F.col("scope") == "static_wildcard").alias("__static"))
    for key, mark in (("__type", "__imported"), ("__name", "__named")):
        out = out.join(types.select("path", F.col("name").alias(key), F.lit(True).alias(mark)).hint("merge"), ["path", key], "left")
    members = index.where("scope = 'static_member'").select("path", F.col("name").alias("mth"), F.lit(True).alias("__member"))
    out = out.join(per_file.hint("merge"), "path", "left").join(members.hint("merge"), ["path", "mth"], "left").join(packages.hint("merge"), "path", "left").join(flags, "application", "left")
    typed = F.col("__type").isNotNull()
    tests = {
        "field": F.col("__field_"), "local_new": typed & F.col("__new_"), "parameter": typed & F.col("__param_"), "imported_type": F.col("__imported"), "imported_root": F.col("__named"),
        "wildcard": typed & F.col("__wild"), "same_package": typed & F.col("package").startswith(own), "typed": typed,
        "include_unqualified": F.col("include_unqualified"), "static_member": F.col("__member"), "static_wildcard": F.col("__static"),
    }
    qualified = F.coalesce(*[F.when(tests[rule] & (F.col(flag) if flag else F.lit(True)), rule) for rule, flag in KEEP_RULES])
    bare = F.coalesce(*[F.when(tests[rule], rule) for rule in BARE_RULES])
    return out.select(*[F.col(c) for c in calls.columns], F.when(F.col("root").isNull(), bare).otherwise(qualified).alias("kept_by"))


# --- field chains -----------------------------------------------------------------------------------------------------


def fold_chains(chains: DataFrame, types: DataFrame, classes: DataFrame, returns: DataFrame, impls: DataFrame | None = None) -> DataFrame:
    """id, cls, mth of paths a.b.c.m: the class that m is called on, and m.

    The first token goes through the whole lookup. Each further one is a variable of the file, else of any file, else a
    method of the class found so far that returns something, else it changes nothing. What a variable says does not
    depend on the class before it, so one join answers it for all tokens of all chains; only the tokens behind a chain's
    last variable are folded, a position of all chains a round, on (class, token).

    chains: id, file_name, class_interface_name, path; types: file_name, var, type, pos; classes: cls; returns: cls,
    method, ret, pos. A path without a dot is called on the caller's class.
    """
    cut = F.transform(F.split("path", r"\."), lambda x: F.trim(x))
    own = chains.select("id", "file_name", "class_interface_name", F.filter(cut, lambda x: x != "").alias("all"))
    own = materialize(own.select("id", "file_name", "class_interface_name", F.element_at("all", -1).alias("mth"), F.slice("all", F.lit(1), F.greatest(F.size("all") - 1, F.lit(0))).alias("toks")))
    first = lookup.lookup_type(own.withColumn("__first", F.get("toks", F.lit(0))), F.col("__first"), types, classes, impls).select("id", "resolved")
    scoped = lookup.variable_types(types.select("file_name", F.lower("var").alias("v"), "type", "pos"), ["file_name", "v"]).withColumnRenamed("var_type", "s")
    anywhere = lookup.variable_types(types.select(F.lower("var").alias("v"), "type", "pos"), ["v"]).withColumnRenamed("var_type", "g")
    later = own.select("id", "file_name", F.posexplode("toks").alias("at", "tok")).where("at > 0").withColumn("v", F.lower("tok"))
    known = later.join(scoped, ["file_name", "v"], "left").join(anywhere, "v", "left").withColumn("t", T.strip_generics(F.coalesce("s", "g"))).where("t IS NOT NULL")
    last = known.groupBy("id").agg(F.max(F.struct("at", "t")).alias("last"))
    state = own.join(first, "id").join(last, "id", "left").select("id", "mth", F.coalesce("last.t", "resolved").alias("cls"), F.expr("slice(toks, coalesce(last.at, 0) + 2, size(toks))").alias("toks"))
    ret = lookup.return_types(returns).where(~F.lower("ret").isin("void", "<constructor>") & (F.col("ret") != "")).select("cls", F.col("method").alias("tok"), T.strip_generics(F.element_at(F.split("ret", r"\."), -1)).alias("ret"))
    open_, done = materialize(state), None
    while True:
        part = open_.where(F.size("toks") == 0).select("id", "cls", "mth")
        done = part if done is None else done.unionByName(part)
        open_ = open_.where(F.size("toks") > 0)
        if open_.isEmpty():
            return done
        step = open_.withColumn("tok", F.get("toks", F.lit(0))).join(ret, ["cls", "tok"], "left")
        open_ = materialize(step.select("id", "mth", F.coalesce("ret", "cls").alias("cls"), F.expr("slice(toks, 2, size(toks))").alias("toks")))
