"""Spans of source text: braces and brackets with their partners, method bodies as activations, lines of methods.

Tokens are rows with a position; depths are running sums over a file's tokens, and what encloses what is read off windows
at one depth, so nothing nests in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.operators import ordering
from calltrail.operators.shared import discard, materialize


def with_depth(tokens: DataFrame) -> DataFrame:
    """tokens with depth: open braces around each; a brace's own depth is that of what stands beside it."""
    step = F.when(F.col("kind") == "open", 1).when(F.col("kind") == "close", -1).otherwise(0)
    return ordering.running_depth(tokens, ["path"], step, ["pos"], "depth").withColumn("depth", F.col("depth") - (F.col("kind") == "open").cast("int"))


def with_scope(tokens: DataFrame) -> DataFrame:
    """Calls with scope and opened: name and position of the innermost declaration whose body is open around them.

    At each depth below a call, the last declaration there counts until its body's brace closes at that depth. Two bodies
    of one name differ in `opened`. Calls outside of methods have nulls. tokens: path, kind, name, recv, pos. They are
    sorted and read once, in as many tasks as shuffles have: packed tokens look like work for a few, and sorts of a task
    hold them unpacked.
    """
    dealt = tokens.repartition(int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path")
    deep = with_depth(dealt).where("kind <> 'open'")
    below = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("depth") - 1, F.lit(0)))
    levels = deep.withColumn("level", F.explode(F.when(F.col("kind") == "call", below).otherwise(F.array("depth"))))
    w = Window.partitionBy("path", "level").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    decl = F.struct(F.col("name").alias("scope"), F.col("pos").alias("opened"))
    state = F.last(F.when(F.col("kind") == "decl", decl).when(F.col("kind") == "close", F.struct(F.lit(None).cast("string").alias("scope"), F.lit(None).cast("long").alias("opened"))), ignorenulls=True).over(w)
    seen = levels.withColumn("open", state).where("kind = 'call'")
    inner = F.max_by("open", F.when(F.col("open.opened").isNotNull(), F.col("level")))
    return seen.groupBy("path", "pos", "name", "recv").agg(inner.alias("open")).select("path", "pos", "name", "recv", "open.scope", "open.opened")


def scan_key(path: str = "path") -> list[Column]:
    """Order of a walk over folders: a folder's own files before its folders, names in order."""
    parts = F.split(path, "/")
    return [F.slice(parts, F.lit(1), F.size(parts) - 1).alias("__dirs"), F.element_at(parts, -1).alias("__file")]


def call_order(tokens: DataFrame) -> DataFrame:
    """cls, mth, recv, callee, rank, path, opened: the calls of each opened body, in one count over all files.

    A body counts a receiver and callee once, at its first place; overloads and repeated bodies count on their own, and a
    call belongs to the innermost body. Names are in lower case, cls is the file's stem. Ranks of different bodies
    compare, so that a fallback over all of them means something. Places are written before they are ranked, as bounds of
    ranges are drawn by reading all rows.
    """
    own = with_scope(tokens).where("opened IS NOT NULL")
    first = materialize(own.groupBy("path", "opened", F.lower("scope").alias("mth"), F.lower("recv").alias("recv"), F.lower("name").alias("callee")).agg(F.min("pos").alias("pos")))
    ranked = ordering.global_rank(first.select("*", *scan_key()), ["__dirs", "__file", "pos"], "rank")
    discard(first)
    return ranked.select(F.lower(T.file_stem(F.col("path"))).alias("cls"), "mth", "recv", "callee", "rank", "path", "opened")


def decl_order(tokens: DataFrame) -> DataFrame:
    """cls, mth, rank: the first declaration of each class and method name, counted over all files; in lower case."""
    own = tokens.where("kind = 'decl'").select(F.lower(T.file_stem(F.col("path"))).alias("cls"), F.lower("name").alias("mth"), "pos", *scan_key())
    first = own.groupBy("cls", "mth").agg(F.min(F.struct("__dirs", "__file", "pos")).alias("at")).select("cls", "mth", "at.*")
    return ordering.global_rank(first, ["__dirs", "__file", "pos"], "rank").select("cls", "mth", "rank")


# --- brackets ---------------------------------------------------------------------------------------------------------

OPENERS, CLOSERS = ("(", "[", "{"), (")", "]", "}")


def with_partners(marks: DataFrame) -> DataFrame:
    """Opening brackets with closes and close_line: where their partner stands, null where none does.

    Each kind of bracket has its own depth, so one that closes nothing disturbs its own kind only; a partner is the next
    closing one of the same depth. marks: path, pos, line, text.
    """
    kind = F.when(F.col("text").isin("(", ")"), "round").when(F.col("text").isin("[", "]"), "square").when(F.col("text").isin("{", "}"), "curly")
    opens = F.col("text").isin(*OPENERS)
    own = marks.withColumn("kind", kind).where("kind IS NOT NULL")
    deep = ordering.running_depth(own, ["path", "kind"], F.when(opens, 1).otherwise(-1), ["pos"], "depth").withColumn("depth", F.col("depth") - opens.cast("int"))
    w = Window.partitionBy("path", "kind", "depth").orderBy("pos")
    ahead = F.lead(F.struct(F.col("text").alias("t"), F.col("pos").alias("p"), F.col("line").alias("l"))).over(w)
    out = deep.withColumn("n", ahead).where(opens).withColumn("n", F.when(F.col("n.t").isin(*CLOSERS), F.col("n")))
    return out.select("path", "kind", "text", "pos", "line", "depth", F.col("n.p").alias("closes"), F.col("n.l").alias("close_line"))


#: Words that stand before a call and not before the name of a declaration.
NO_TYPE = ("new", "return", "else", "throw", "case", "assert", "instanceof", "do", "yield")


def with_members(tokens: DataFrame) -> DataFrame:
    """tokens with round (open round brackets before each), member (number of the run up to a brace or semicolon outside
    of brackets), start_line of its run, value (an assignment or a statement's word stands before it there), and what
    stands around it: before, before2, after.

    A run starts anew behind a line without tokens, as annotations end there, unless that line is within brackets.
    """
    w = Window.partitionBy("path").orderBy("pos")
    so_far = w.rowsBetween(Window.unboundedPreceding, -1)
    text = F.col("text")
    step = F.when((F.col("kind") == "mark") & (text == "("), 1).when((F.col("kind") == "mark") & (text == ")"), -1).otherwise(0)
    own = tokens.select("path", "kind", "text", "pos", "line", F.coalesce(F.sum(step).over(so_far), F.lit(0)).alias("round"), *[f.over(w).alias(n) for f, n in ((F.lag("text"), "before"), (F.lag("text", 2), "before2"), (F.lead("text"), "after"), (F.lead("pos"), "after_pos"), (F.lag("line"), "line_before"))])
    free = F.col("round") == 0
    ends = (F.col("kind") == "mark") & text.isin("{", "}", ";") & free
    own = own.withColumn("ends", ends).withColumn("member", F.coalesce(F.sum(F.col("ends").cast("int")).over(so_far), F.lit(0)))
    m = Window.partitionBy("path", "member").orderBy("pos")
    up_to = m.rowsBetween(Window.unboundedPreceding, 0)
    fresh = (F.row_number().over(m) == 1) | (free & (F.col("line") > F.col("line_before") + 1))
    odd = free & (text.isin("=", *NO_TYPE))
    return own.withColumn("fresh", fresh).withColumn("start_line", F.last(F.when(F.col("fresh"), F.col("line")), ignorenulls=True).over(up_to)).withColumn("value", F.max(odd).over(up_to)).drop("fresh", "line_before")


def class_blocks(members: DataFrame, partners: DataFrame) -> DataFrame:
    """path, cls, opens, closes of declared types: the brace that ends the run of the name, to its partner or the file's end."""
    heads = members.where("kind = 'word' AND before IN ('class', 'interface', 'enum') AND coalesce(before2, '') <> '.'").select("path", "member", F.col("text").alias("cls"))
    braces = members.where("ends AND text = '{'").select("path", "member", F.col("pos").alias("opens"))
    opened = heads.hint("merge").join(braces, ["path", "member"])
    return opened.join(partners.where("kind = 'curly'").select("path", F.col("pos").alias("opens"), "closes").hint("merge"), ["path", "opens"], "left").select("path", "cls", "opens", F.coalesce("closes", F.lit(1 << 62)).alias("closes"))


def _param_types(args: Column) -> Column:
    """Types of a parameter list's text, without annotations, type arguments and modifiers; of variable number as arrays."""
    plain = F.regexp_replace(F.regexp_replace(args, r"@[\w.]+(\([^)]*\))?", " "), r"\b(final|volatile|transient)\b", " ")
    for _ in range(3):  # type arguments within type arguments
        plain = F.regexp_replace(plain, r"<[^<>]*>", "")
    parts = F.filter(F.transform(F.split(plain, ","), lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    return F.transform(parts, lambda x: F.regexp_replace(F.regexp_replace(F.replace(x, F.lit("..."), F.lit("[]")), r"\s*[A-Za-z_$][\w$]*\s*((\[\s*\])*)$", "$1"), r"\s+", ""))


def method_lines(files: DataFrame, tokens: DataFrame) -> DataFrame:
    """path, cls, mth, pos, types, and the lines of each declaration by four rules.

    block: from the first annotation to the partner of the brace, or to the semicolon where that comes first. block_filled:
    the same without blank lines. opened_filled: to the partner of the next brace, whatever comes before it, without blank
    lines; 1 where there is none. file_first: as opened, with blank lines, of the first declaration of that name in the
    file. A brace without a partner reaches to the end of the file.

    A declaration is a name before a round bracket that is not within others, with a type before it or the name of a
    class around it, and a brace, a semicolon or throws behind the bracket. It has a row for each class that it stands in,
    nested ones too. files: path, text; tokens: path, kind (word, number, string, char, mark), text, pos, line. All joins are
    by sorting, as written tokens look small and are many.
    """
    members = materialize(with_members(tokens))
    partners = materialize(with_partners(members.where("kind = 'mark'").select("path", "text", "pos", "line")))
    blocks = materialize(class_blocks(members, partners))
    named = members.where((F.col("kind") == "word") & (F.col("after") == "(") & (F.col("round") == 0) & ~F.col("text").isin(*T.CONTROL_WORDS) & (F.coalesce("before", F.lit("")) != "@"))
    made = blocks.select("path", F.col("cls").alias("text"), F.lit(True).alias("made")).distinct().hint("merge")
    typed = (F.col("before").rlike(r"^[A-Za-z_$]") & ~F.col("before").isin(*NO_TYPE)) | (F.col("before").isin(">", "]") & (F.coalesce("before2", F.lit("")) != "-"))
    named = named.where(~F.col("value")).join(made, ["path", "text"], "left").where(typed | (F.col("made") & ~F.coalesce("before", F.lit("{")).isin(".", "@")))
    round_ = partners.where("kind = 'round'").select("path", F.col("pos").alias("after_pos"), F.col("closes").alias("args_end"))
    named = named.select("path", "member", F.col("text").alias("mth"), "pos", "start_line", "after_pos").join(round_.hint("merge"), ["path", "after_pos"])
    behind = members.where("text = ')'").select("path", F.col("pos").alias("args_end"), F.col("after").alias("behind"))
    named = named.join(behind.hint("merge"), ["path", "args_end"]).where("behind IN ('{', ';', 'throws')")
    stop = members.where("ends").select("path", "member", F.col("text").alias("stop"), F.col("pos").alias("stop_pos"), F.col("line").alias("stop_line"))
    w = Window.partitionBy("path").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)  # from the end, as frames to the end are begun anew for each row
    next_brace = F.last(F.when((F.col("kind") == "mark") & (F.col("text") == "{"), F.col("pos")), ignorenulls=True).over(w)
    braces = members.select("path", "kind", "text", "pos").withColumn("brace", next_brace).select("path", F.col("pos").alias("args_end"), "brace")
    curly = partners.where("kind = 'curly'").select("path", F.col("pos").alias("brace"), "close_line")
    found = named.join(stop.hint("merge"), ["path", "member"]).join(braces.hint("merge"), ["path", "args_end"]).join(curly.hint("merge"), ["path", "brace"], "left")
    known = F.struct("mth", "pos", "start_line", "after_pos", "args_end", "stop", "stop_line", "brace", "close_line")
    texts = files.select("path", "text", F.split("text", "\n").alias("lines"))  # a text meets its declarations once, not a copy each

    def measured(d: Column) -> Column:
        far = F.coalesce(d["close_line"], F.size("lines"))
        start, end = d["start_line"], F.when(d["stop"] == "{", far).otherwise(d["stop_line"])
        filled = lambda last: F.size(F.filter(F.slice("lines", start, last - start + 1), lambda x: F.regexp_replace(x, r"^\s+", "") != ""))
        args = F.col("text").substr((d["after_pos"] + 2).cast("int"), (d["args_end"] - d["after_pos"] - 1).cast("int"))
        none = d["brace"].isNull()
        values = {"mth": d["mth"], "pos": d["pos"], "types": _param_types(args), "block": end - start + 1, "block_filled": filled(end), "opened_filled": F.when(none, 1).otherwise(filled(far)), "opened": F.when(none, 1).otherwise(far - start + 1)}
        return F.struct(*[v.alias(k) for k, v in values.items()])

    one = found.groupBy("path").agg(F.collect_list(known).alias("of")).hint("merge").join(texts, "path").select("path", F.inline(F.transform("of", measured)))
    first = F.first("opened").over(Window.partitionBy("path", F.lower("mth")).orderBy("pos")).alias("file_first")
    one = one.select("path", "mth", "pos", "types", "block", "block_filled", "opened_filled", first)
    inside = (F.col("pos") > F.col("opens")) & (F.col("pos") < F.col("closes"))
    return one.join(blocks.hint("merge"), "path").where(inside).select("path", "cls", "mth", "pos", "types", "block", "block_filled", "opened_filled", "file_first")
