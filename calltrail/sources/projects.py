"""Languages as projects: what a language has to provide, as tables over a whole source tree.

A project parses its files once, into a written table, and every method is a DataFrame over it; another language takes
part by a class with these methods and a name in PROJECTS. Where a language has nothing to say, the base class gives an
empty table of the same columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calltrail.functions import text as T
from calltrail.operators import lookup, resolution, spans
from calltrail.operators.shared import materialize
from calltrail.sources import adapters, files as S, java
from calltrail.sources.settings import Config


@dataclass
class Flags:
    """Behaviour of an application. Bare calls; locals typed by their constructor; roots that are parameters; types of the
    own package."""

    include_unqualified: bool = True
    accept_local_new_types: bool = True
    accept_parameter_types: bool = True
    accept_same_package: bool = True


TABLES = {
    "declared_types": "path STRING, cls STRING, type STRING, extends STRING, implements STRING, annotations STRING",
    "methods": "path STRING, cls STRING, mth STRING, params STRING",
    "metadata": "path STRING, cls STRING, mth STRING, params STRING, returns STRING, access STRING, arity INT, annotations STRING",
    "calls": "path STRING, cls STRING, mth STRING, params STRING, call STRING, how STRING, kept_by STRING",
    "fallback": "path STRING, error STRING, rows BIGINT",
    "variable_types": "file_name STRING, var STRING, type STRING",
    "return_index": "cls STRING, method STRING, ret STRING",
    "parents": "cls STRING, parent STRING",
    "type_index": "key STRING, path STRING, how STRING",
    "method_lines": "path STRING, cls STRING, mth STRING, pos BIGINT, types ARRAY<STRING>, block INT, block_filled INT, opened_filled INT, file_first INT",
}


class Project:
    """files: path, text. Each method returns the columns of TABLES under its name."""

    extension = ""

    def __init__(self, files: DataFrame, config: Config | None = None, flags: Flags | None = None):
        self.files, self.config, self.flags = files, config or Config(), flags or Flags()

    def _empty(self, name: str) -> DataFrame:
        return self.files.sparkSession.createDataFrame([], TABLES[name])

    def declared_types(self) -> DataFrame:
        return self._empty("declared_types")

    def methods(self) -> DataFrame:
        return self._empty("methods")

    def metadata(self) -> DataFrame:
        return self._empty("metadata")

    def calls(self) -> DataFrame:
        """All calls; kept_by is null where the application's flags and the file's imports keep it out."""
        return self._empty("calls")

    def fallback(self) -> DataFrame:
        """Files that do not parse, and how many rows were found in them nevertheless."""
        return self._empty("fallback")

    def is_system_call(self, call: Column) -> Column:
        return F.lit(False)

    def keywords(self) -> tuple[str, ...]:
        return self.config.words("control_keywords")

    def variable_types(self) -> DataFrame:
        return self._empty("variable_types")

    def return_index(self) -> DataFrame:
        return self._empty("return_index")

    def parents(self) -> DataFrame:
        return self._empty("parents")

    def type_index(self) -> DataFrame:
        return self._empty("type_index")

    def method_lines(self) -> DataFrame:
        return self._empty("method_lines")

    def properties(self, lines: DataFrame) -> DataFrame:
        """key, value of property files. lines: path, line_no, line."""
        return S.properties(lines)


class JavaProject(Project):
    extension = ".java"

    @cached_property
    def own(self) -> DataFrame:
        return materialize(self.files.select("path", "text"))

    @cached_property
    def rows(self) -> DataFrame:
        return materialize(java.parse_sources(self.own, accept_new_types=self.flags.accept_local_new_types))

    def kind(self, name: str) -> DataFrame:
        return self.rows.where(F.col("kind") == name)

    def declared_types(self) -> DataFrame:
        return self.kind("type").where("type <> 'anonymous'").select("path", "cls", "type", F.col("name").alias("extends"), F.col("extra").alias("implements"), F.col("ann").alias("annotations"))

    def methods(self) -> DataFrame:
        return self.kind("method").select("path", "cls", "mth", F.coalesce("extra", F.lit("")).alias("params"))

    def metadata(self) -> DataFrame:
        return self.kind("method").select("path", "cls", "mth", F.coalesce("extra", F.lit("")).alias("params"), F.col("type").alias("returns"), F.col("name").alias("access"), F.col("n").alias("arity"), F.col("ann").alias("annotations"))

    def _body(self, params: str) -> Column:
        return F.concat_ws("|", "path", "cls", "mth", F.coalesce(params, F.lit("")))

    def calls(self) -> DataFrame:
        sites = self.rows.where("kind IN ('site', 'call', 'var', 'field')")
        found = resolution.resolved_calls(sites, self.flags.include_unqualified)
        first = F.get(F.split("name", r"\."), F.lit(0))
        root = F.when(first.isin("this", "super"), F.get(F.split("name", r"\."), F.lit(1))).otherwise(first)
        asked = self.kind("site").where("type IN ('plain', 'index')").select(F.lit(0).alias("application"), "path", "cls", self._body("ann").alias("body"), "pos", F.when(~root.endswith("()"), root).alias("root"), F.regexp_replace(root, r"\(\)$", "").alias("mth"))
        variables = self.kind("var").select(self._body("ann").alias("body"), "name", "type", "extra").withColumn("how", F.col("extra"))
        flags = self.files.sparkSession.range(1).select(F.lit(0).alias("application"), *[F.lit(getattr(self.flags, f)).alias(f) for f in ("include_unqualified", "accept_local_new_types", "accept_parameter_types", "accept_same_package")])
        packages = self.kind("package").select("path", F.col("name").alias("package"))
        fields = self.kind("field").select("cls", "name")
        kept = resolution.keep_calls(asked, variables, fields, resolution.import_index(self.kind("import")), packages, flags).select("path", "pos", F.col("kept_by").alias("__kept"))
        kept = kept.unionByName(self.kind("site").where("type IN ('cast', 'made')").select("path", "pos", F.lit("typed").alias("__kept")))
        made = F.when(F.col("type").isin("ctor", "throw"), "constructor").when(F.col("name").startswith(F.concat("cls", F.lit("."))), "own class").when(F.col("type") == "dynamic", "result")
        return found.join(kept.groupBy("path", "pos").agg(F.max("__kept").alias("__kept")), ["path", "pos"], "left").select("path", "cls", "mth", F.coalesce("ann", F.lit("")).alias("params"), F.col("name").alias("call"), F.col("type").alias("how"), F.coalesce("__kept", made).alias("kept_by"))

    def fallback(self) -> DataFrame:
        errors = self.kind("error").select("path", F.col("name").alias("error"))
        found = self.rows.where("fallback AND kind <> 'error'").groupBy("path").agg(F.count("*").alias("rows"))
        return errors.join(found, "path", "left").select("path", "error", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))

    def is_system_call(self, call: Column) -> Column:
        return T.is_system_call(call)

    def keywords(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys([*T.SELF_ROOTS, *self.config.words("control_keywords")]))

    def variable_types(self) -> DataFrame:
        """Variables of files, primitive types left out: the first declaration, unless a collection gives way to a later type."""
        seen = self.rows.where("kind IN ('var', 'field')").where(~F.col("type").isin(*self.config.words("PRIMITIVE")))
        own = seen.select(F.lower(F.regexp_replace("path", "^.*/", "")).alias("file_name"), F.lower("name").alias("var"), "type", "pos")
        return lookup.variable_types(own, ["file_name", "var"]).withColumnRenamed("var_type", "type")

    def return_index(self) -> DataFrame:
        """The last declaration of a class and name, files in order."""
        return self.kind("method").groupBy("cls", F.col("mth").alias("method")).agg(F.max_by("type", F.struct("path", "pos")).alias("ret"))

    def parents(self) -> DataFrame:
        return self.kind("type").where("name IS NOT NULL AND type <> 'anonymous'").groupBy("cls").agg(F.max_by(T.clean_type(F.col("name")), "path").alias("parent"))

    def type_index(self) -> DataFrame:
        return S.type_index(self.own, self.declared_types())

    def method_lines(self) -> DataFrame:
        return spans.method_lines(self.own, java.all_tokens(self.own))


class ScriptProject(Project):
    """Calls with a number in the scripts of pages."""

    extension = ".html"

    def calls(self) -> DataFrame:
        found = adapters.parse(self.files.withColumn("language", F.lit("script")), "language").where("kind = 'call'")
        return found.select("path", "cls", "mth", F.lit("").alias("params"), F.col("name").alias("call"), F.col("type").alias("how"), F.lit("own class").alias("kept_by"))


PROJECTS: dict[str, type[Project]] = {"java": JavaProject, "script": ScriptProject}


def open_project(language: str, files: DataFrame, config: Config | None = None, flags: Flags | None = None) -> Project:
    """The project of a language; an unknown one is a KeyError."""
    return PROJECTS[language](files, config, flags)
