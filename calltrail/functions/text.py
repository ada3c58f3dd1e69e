"""Column expressions on call strings, tokens, names and paths. All stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that mean "no call".
SENTINELS = ("", "none", "null", "na")
#: Roots that stand for the caller's own class.
SELF_ROOTS = ("return", "this", "super", "new")
#: Qualifiers of calls into the platform.
SYSTEM_QUALIFIERS = ("logger", "log", "system", "string", "objects", "arrays", "collections", "optional", "stream", "httpsecurity", "security")
#: Method names of the platform, lower case.
SYSTEM_METHODS = tuple(
    """length size isempty ispresent value catch equals equalsignorecase hashcode tostring getmessage tolowercase
    touppercase trim split substring replace replaceall return stringbuffer setstring getstring contains containsall
    charat toarray compareto entryset allmatch append indexof removeall body exists isdirectory tofile contentlength
    parseint printstacktrace parselong savefilecontent createnewdirectory anymatch detect close endtext gettime save
    findfirst data isspecialcharacter showtext channel handle bigdecimal delete delay enrichheaders copyheaders and
    denyall permitall httpbasic url frameoption add remove put get clear computeifabsent containskey containsvalue count
    distinct stream map flatmap filter collect foreach orelse orelseget debug info warn error trace build headers csrf
    authorizehttprequests requestmatchers sessionmanagement abs max min round ceil floor rint pow sqrt cbrt exp expm1
    log random""".split()
)
#: Words before "(" that are no calls.
CONTROL_WORDS = tuple("if else while for switch return try catch finally new throw assert class interface enum import package void int long double float boolean byte char short string static final abstract public private protected synchronized super this".split())
#: Words that are no calls, by rule; the lists differ, and case counts.
SKIP_WORDS = {
    "order": CONTROL_WORDS,
    "order_without_scope": tuple(
        """if else while for switch return try catch finally new throw assert class interface enum import package void int long
        double float boolean byte char short String static final abstract public private protected synchronized""".split()
    ),
    "calls": tuple("if for while switch catch new return synchronized this super assert equals".split()),
}
NO_RANK = 1_000_000_000


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends; trim() of the JVM takes blanks alone."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_generics(c: Column) -> Column:
    return F.regexp_replace(c, r"\s*<[^>]+>\s*", "")


def simple_type(c: Column) -> Column:
    """What stands behind the last dot, without type arguments."""
    return F.element_at(F.split(strip_generics(c), r"\."), -1)


def strip_parens(c: Column) -> Column:
    return F.regexp_replace(c, r"\([^)]*\)", "")


def unescape_basic(c: Column) -> Column:
    """The five entities of markup; "&" last, so that nothing is decoded twice."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def keyword_root(call: Column, parent: Column) -> Column:
    """this.m(...), super.m, return.m and new.m name the caller's class."""
    pattern = r"(?is)^\s*(?:return|this|super|new)\s*\.\s*([A-Za-z_][A-Za-z0-9_]*)(.*)$"
    return F.when(call.rlike(pattern), F.concat(strip_generics(parent), F.lit("."), F.regexp_extract(call, pattern, 1), F.regexp_extract(call, pattern, 2))).otherwise(call)


def call_base(call: Column) -> Column:
    """Base of Base.method..., null without one."""
    return F.nullif(F.regexp_extract(call, r"^\s*([A-Za-z_][A-Za-z0-9_]*)\s*\.", 1), F.lit(""))


def call_method(call: Column) -> Column:
    """The last name before the first parenthesis, null where there is none."""
    return F.nullif(F.regexp_extract(call, r"([A-Za-z_][A-Za-z0-9_]*)\s*(?:\(.*)?$", 1), F.lit(""))


def upper_first(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def starts_upper(c: Column) -> Column:
    first = F.substring(c, 1, 1)
    return (first == F.upper(first)) & (first != F.lower(first))


def method_key(cls: Column, method: Column, params: Column) -> Column:
    return F.concat(cls, F.lit("."), method, F.lit("("), F.coalesce(params, F.lit("")), F.lit(")"))


def file_stem(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"\.[^.]*$", "")


def node_label(cls: Column, method: Column, loc: Column) -> Column:
    return F.concat(cls, F.lit("."), method, F.lit(" no_of_lines : "), F.coalesce(loc, F.lit(0)).cast("string"))


def label_node(label: Column) -> Column:
    """Class.method of a label, in lower case; null without a dot."""
    base = F.lower(F.substring_index(label, " ", 1))
    return F.when(base.contains("."), base)


_TOKEN = r"(?i)^(.*?)\s+no_of_lines\s*:\s*(\d+|Nil|None)\s*$"


def parse_token(token: Column) -> Column:
    """struct(kind, name, loc): a chunk id, or a method with its lines; Nil, None and no count are 0."""
    t = strip(token)
    chunk = is_chunk_id(t)
    loc = F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(t, _TOKEN, 2), F.lit("")), F.lit("9999999999")).cast("long"), F.lit(0))
    name = F.when(t.rlike(_TOKEN), strip(F.regexp_extract(t, _TOKEN, 1))).otherwise(t)
    return F.struct(
        F.when(F.coalesce(t, F.lit("")) == "", F.lit("other")).when(chunk, F.lit("chunk")).otherwise(F.lit("method")).alias("kind"),
        F.when(chunk, t).otherwise(F.coalesce(name, F.lit(""))).alias("name"),
        F.when(~F.coalesce(chunk, F.lit(False)) & (F.coalesce(t, F.lit("")) != ""), F.when(t.rlike(r"(?i)(Nil|None)\s*$"), F.lit(0)).otherwise(loc)).cast("long").alias("loc"),
    )


def format_token(name: Column, loc: Column) -> Column:
    return F.concat(name, F.lit(" no_of_lines : "), F.when(F.coalesce(loc, F.lit(0)) == 0, F.lit("Nil")).otherwise(loc.cast("string")))


def is_chunk_id(c: Column) -> Column:
    return F.trim(c).rlike(r"^C[0-9]{3}_.+")


def is_group_id(c: Column) -> Column:
    return F.trim(c).rlike(r"(?i)^(G|GRP|GROUP)[-_]?[0-9]+([.][0-9]+)?$")


def split_list(c: Column, trim: Callable[[Column], Column] = strip) -> Column:
    """Trimmed parts between commas without empty ones; null is the empty list. trim: of white space of any kind, or F.trim for blanks alone."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: trim(x)), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def cut_marker(c: Column) -> Column:
    return F.substring_index(c, "||", 1)


def clean_type(c: Column) -> Column:
    """Without type arguments and array marks."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", ""), r"\[\s*\]", ""))


def normalize_ref(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"^(classpath|file):", "")


def normal_type(c: Column) -> Column:
    """For comparing types: last dotted part, array mark without spaces, lower case."""
    return F.lower(F.regexp_replace(F.element_at(F.split(F.trim(c), r"\."), -1), r"\s*\[\s*\]", "[]"))


def strip_top_level(code: Column) -> Column:
    """Without line comments that begin their line, then without block comments that hold no brace. What stands before a
    line comment on its line stays, and so does a block comment with a brace, as a whole."""
    lines = F.regexp_replace(code, r"(?md)^\s*//.*$", "")
    return F.regexp_replace(lines, r"(?s)/\*(?:(?!\*/)[^{}])*+\*/|(/\*.*?\*/)", "$1")


def normalize_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def is_system_call(call: Column) -> Column:
    """Platform qualifier, or platform method: the name before the first parenthesis, so dots in arguments do not count. Null is none."""
    plain = F.lower(F.trim(strip_generics(call)))
    method = F.element_at(F.split(F.substring_index(plain, "(", 1), r"\."), -1)
    method = F.trim(F.regexp_replace(method, "[;\"']", ""))
    return F.coalesce(plain.rlike("^(" + "|".join(SYSTEM_QUALIFIERS) + r")\.") | method.isin(*SYSTEM_METHODS), F.lit(False))


def is_sentinel(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin(*SENTINELS), F.lit(True))


def offset_to_line(text: Column, offset: Column) -> Column:
    """1-based line of a 0-based offset."""
    before = F.substring(text, F.lit(1), offset)
    return (F.length(before) - F.length(F.replace(before, F.lit("\n"))) + 1).cast("int")


def commented(line: Column) -> Column:
    t = F.ltrim(line)
    return t.startswith("//") | t.startswith("/*") | t.startswith("*")


def path_dirs_pruned(path: Column) -> Column:
    """Path holds none of the build directories."""
    return ~path.rlike(r"/(target|bin|build|out|\.git|node_modules)/")
