"""Source trees as tables: file scans, decoding, properties files, and named-table workbooks."""

from __future__ import annotations

import html
import json
import re
import uuid
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from calltrail.functions.text import file_stem, path_dirs_pruned, strip
from calltrail.operators.shared import materialize


def decode_source(content: Column) -> Column:
    """UTF-8, or Latin-1 where the bytes are no UTF-8."""
    return F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))


def decode_lossy(content: Column) -> Column:
    """UTF-8 without the bytes that are none. A replacement character that the bytes really hold stays: EF starts a
    character wherever it stands, so the bytes are cut at EF BF BD, and each part is decoded alone."""
    drop = lambda c: F.replace(F.make_valid_utf8(c.cast("string")), F.lit("\ufffd"), F.lit(""))
    pairs = F.regexp_replace(F.hex(content), "(..)", "$1 ")
    parts = F.transform(F.split(pairs, "EF BF BD "), lambda x: drop(F.unhex(F.replace(x, F.lit(" "), F.lit("")))))
    return F.when(F.hex(content).contains("EFBFBD"), F.array_join(parts, "\ufffd")).otherwise(drop(content))


@F.pandas_udf(T.StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    """All named and numbered entities. The JVM has no function for them."""
    return text.map(html.unescape, na_action="ignore")


def scan_files(spark: SparkSession, folder: str, suffix: str = ".java", pruned: bool = False) -> DataFrame:
    """path, file_name, stem, text of all files below a folder, decoded; pruned: not those below build folders in it.

    Where the folder itself stands does not matter. It is a plain path, without patterns.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}").load(folder)
    if pruned:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        root = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")
        files = files.where(path_dirs_pruned(F.substring("path", len(root) + 1, 1 << 30)))
    name = F.regexp_replace("path", "^.*/", "")
    return files.select("path", name.alias("file_name"), file_stem(name).alias("stem"), decode_source(F.col("content")).alias("text"))


def properties(lines: DataFrame) -> DataFrame:
    """key, value of lines (path, line_no, line): blank lines and comments go; at the first "=", else the first ":"; the last file wins.

    White space of any kind around lines, keys and values goes, a carriage return at the end too."""
    own = lines.withColumn("line", strip(F.col("line"))).where((F.col("line") != "") & ~F.col("line").rlike("^[#!]"))
    at = F.when(F.col("line").contains("="), F.instr("line", "=")).otherwise(F.instr("line", ":"))
    pair = own.withColumn("at", at).where("at > 0").select("path", "line_no", strip(F.expr("substr(line, 1, at - 1)")).alias("key"), strip(F.expr("substr(line, at + 1)")).alias("value"))
    return pair.groupBy("key").agg(F.max_by("value", F.struct("path", "line_no")).alias("value"))


def refs_to_files(refs: DataFrame, files: DataFrame) -> DataFrame:
    """ref, path: files whose path ends with the reference; where there is none, those with its base name."""
    base = lambda c: F.regexp_replace(c, "^.*/", "")
    r, f = refs.withColumn("base", base("ref")), files.withColumn("base", base("path"))
    same = r.join(f, "base")  # a path that ends with ref has its base name, so an equal key covers both rules
    exact = same.where((F.col("path") == F.col("ref")) | F.endswith("path", F.concat(F.lit("/"), "ref")))
    loose = same.join(exact.select("ref").distinct(), "ref", "left_anti")
    return exact.select("ref", "path").unionByName(loose.select("ref", "path"))


def require_columns(df: DataFrame, needed: list[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


# --- workbooks: a folder of tables, and manifests that say which of them are its sheets -------------------------------

_MANIFEST = re.compile(r"([0-9]{9})\.json$")


def _folder(spark: SparkSession, path: str) -> tuple:
    """(path, file system, file context) in the JVM."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    at = hadoop.Path(path)
    system = at.getFileSystem(conf)
    return at, system, hadoop.FileContext.getFileContext(system.getUri(), conf)


def sheets_of(spark: SparkSession, book: str) -> tuple[int, dict[str, str]]:
    """(version, {sheet: folder}) of the last manifest; version 0 and no sheets where there is no book."""
    at, system, _ = _folder(spark, f"{book}/_manifests")
    if not system.exists(at):
        return 0, {}
    versions = [int(m[1]) for f in system.listStatus(at) if (m := _MANIFEST.match(f.getPath().getName()))]
    if not versions:
        return 0, {}
    text = spark.read.text(f"{book}/_manifests/{max(versions):09d}.json", wholetext=True).first()["value"]
    return max(versions), json.loads(text)


def read_sheet(spark: SparkSession, book: str, sheet: str) -> DataFrame:
    """A named table of a workbook, as the last manifest has it."""
    found = sheets_of(spark, book)[1]
    if sheet not in found:
        raise FileNotFoundError(f"no sheet {sheet!r} in {book}")
    return spark.read.parquet(f"{book}/{found[sheet]}")


def read_sheet_or_empty(spark: SparkSession, book: str, sheet: str, schema: str) -> DataFrame:
    """An empty table where the sheet is missing; other failures stay failures."""
    try:
        return read_sheet(spark, book, sheet)
    except FileNotFoundError:
        return spark.createDataFrame([], T._parse_datatype_string(schema))


def write_sheets(book: str, sheets: dict[str, DataFrame], mode: str = "overwrite") -> dict[str, str]:
    """Writes sheets as tables and commits them together; {sheet: name that it got}.

    overwrite: the book has these sheets alone. update: they replace those of their names, others stay. append: a sheet
    whose name is taken gets a new one, with the first free number behind it. Each sheet goes to a folder of its own, and
    one rename of a manifest makes all of them the book's: a job that fails or a driver that is lost on the way leaves the
    old book. Of two writers at once, one fails. Empty sheets are written too, so that a reader finds their columns.
    """
    if mode not in ("overwrite", "update", "append"):
        raise ValueError(f"no mode {mode!r}")
    spark = next(iter(sheets.values())).sparkSession
    version, old = sheets_of(spark, book)
    now, names = {} if mode == "overwrite" else dict(old), {}
    for name, df in sheets.items():
        own, k = name, 0
        while mode == "append" and own in now:
            own, k = f"{name}{k + 1}", k + 1
        folder = f"{own}-{uuid.uuid4().hex}"
        df.write.parquet(f"{book}/{folder}")
        now[own], names[name] = folder, own
    draft, system, context = _folder(spark, f"{book}/_manifests/.{uuid.uuid4().hex}")
    out = system.create(draft)
    out.write(bytearray(json.dumps(now).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(draft, _folder(spark, f"{book}/_manifests/{version + 1:09d}.json")[0], options)
    return names


def drop_old_sheets(spark: SparkSession, book: str) -> None:
    """Deletes tables that the last manifest does not name, and older manifests. For when nobody reads the old book."""
    version, now = sheets_of(spark, book)
    at, system, _ = _folder(spark, book)
    for f in system.listStatus(at):
        if f.getPath().getName() not in {"_manifests", *now.values()}:
            system.delete(f.getPath(), True)
    for k in range(1, version):
        system.delete(_folder(spark, f"{book}/_manifests/{k:09d}.json")[0], False)


def type_index(files: DataFrame, types: DataFrame, suffix: str = "Impl") -> DataFrame:
    """key, path, how: where a type's name leads: to the file of that stem, else to that of its implementation (stem and
    suffix), else to one that declares it, else to one that declares its implementation; of several, the least path.

    A written table, partitioned by key: build it once, and join references to it. files: path; types: path, cls.
    """
    stem, named = files.select(file_stem(F.col("path")).alias("key"), "path").distinct(), types.select(F.col("cls").alias("key"), "path").distinct()
    parts = []
    for k, (rows, how) in enumerate(((stem, "stem"), (named, "type"))):
        alias = rows.where(F.col("key").endswith(suffix) & (F.length("key") > len(suffix))).withColumn("key", F.expr(f"left(key, length(key) - {len(suffix)})"))
        parts += [rows.select("key", F.struct(F.lit(2 * k).alias("prio"), "path", F.lit(how).alias("how")).alias("to")), alias.select("key", F.struct(F.lit(2 * k + 1).alias("prio"), "path", F.lit(f"{how} of implementation").alias("how")).alias("to"))]
    whole = reduce(DataFrame.unionByName, parts)
    return materialize(whole.groupBy("key").agg(F.min("to").alias("to")).select("key", "to.path", "to.how"))


def trim_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])
