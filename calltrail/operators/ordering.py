"""Aggregates and windows whose rules depend on row order. Every one takes explicit order keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calltrail.operators.shared import materialize, unused


def first_non_null(df: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """One row a key: the first value in order that is not null, column by column. Rows with a null key go.

    min_by aggregates before the shuffle; nothing is sorted.
    """
    own = df.dropna(subset=keys)
    return own.groupBy(*keys).agg(*[F.min_by(v, F.when(F.col(v).isNotNull(), F.struct(*order))).alias(v) for v in values])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in order; null keys are equal. One aggregate over the row as a struct, without a sort."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min_by(row, F.struct(*order)).alias("__row")).select("__row.*")


def ordered_list(value: Column | str, order: list[str]) -> Column:
    """Aggregate: values in order, as an array."""
    v = F.col(value) if isinstance(value, str) else value
    return F.transform(F.array_sort(F.collect_list(F.struct(*order, v.alias("__v")))), lambda s: s["__v"])


def global_rank(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Numbers all rows in a total order, without one task for all: ranges are sorted on their own and offset by the counts before them.

    The sorted ranges are written once, each row with its range and its place there, so that rows and counts come from
    the same draw of range bounds. One shuffle; what is broadcast has a row a range. Ties keep some order.
    """
    p, k, before = (unused(df, c) for c in ("__range", "__place", "__before"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = materialize(ranges.select("*", F.spark_partition_id().alias(p), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(k)))
    counts = placed.groupBy(p).agg(F.count("*").alias(before))
    offsets = counts.select(p, F.coalesce(F.sum(before).over(Window.orderBy(p).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    return placed.join(F.broadcast(offsets), p).withColumn(name, (F.col(before) + F.col(k) + start).cast("long")).drop(p, k, before)


def with_previous(df: DataFrame, order: list[str], columns: list[str], position: str = "pos", size: int = 1 << 16) -> DataFrame:
    """df with its place in the total order and `previous`: the columns of the row before it as a struct, null at the first.

    Rows are numbered over all tasks and looked at in blocks of `size`, each with the last row of the block before it, so
    no window holds more rows than that.
    """
    ranked = global_rank(df, order, position)  # a written table and a broadcast: it may be read twice
    block, mark = unused(ranked, "__block"), unused(ranked, "__mark")
    at = F.col(position)
    own = ranked.withColumn(block, F.floor(at / size)).withColumn(mark, F.lit(False))
    lent = ranked.where(at % size == size - 1).withColumn(block, F.floor(at / size) + 1).withColumn(mark, F.lit(True))
    w = Window.partitionBy(block).orderBy(position)
    return own.unionByName(lent).withColumn("previous", F.lag(F.struct(*columns)).over(w)).where(~F.col(mark)).drop(block, mark)


def global_runs(df: DataFrame, value: str, order: list[str], size: int = 1 << 16) -> DataFrame:
    """value, first, last, n of each run of equal neighbours in the order of the whole table. Nulls are equal."""
    moved = with_previous(df.select(value, *[c for c in order if c != value]), order, [value], size=size)
    new = (F.col("previous").isNull() | ~F.col(value).eqNullSafe(F.col(f"previous.{value}"))).cast("long")
    flagged = materialize(moved.select(value, "pos", F.floor(F.col("pos") / size).alias("__block"), new.alias("__new")))
    before = flagged.groupBy("__block").agg(F.sum("__new").alias("__in")).select("__block", (F.sum("__in").over(Window.orderBy("__block")) - F.col("__in")).alias("__before"))
    w = Window.partitionBy("__block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    named = flagged.withColumn("__run", F.sum("__new").over(w)).join(F.broadcast(before), "__block").withColumn("__run", F.col("__run") + F.col("__before"))
    return named.groupBy("__run", value).agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n")).drop("__run")


def rank_within(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Place of each row among those of its group, from 0. A group's rows may be any share of the table: they are numbered
    with all others, and each group's first number is taken off."""
    ranked = global_rank(df, [*by, *order], name)  # a written table and a broadcast: it may be read twice
    first = ranked.groupBy(*by).agg(F.min(name).alias("__first"))
    return ranked.join(first, by).withColumn(name, F.col(name) - F.col("__first")).drop("__first")


def runs(df: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """by, value, first, last, n of each run of equal neighbours; first and last are positions from 0. Nulls are equal."""
    w = Window.partitionBy(*by).orderBy(*order)
    moved = df.withColumn("__pos", (F.row_number().over(w) - 1).cast("long")).withColumn("__new", (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int"))
    named = moved.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return named.groupBy(*by, "__run", value).agg(F.min("__pos").alias("first"), F.max("__pos").alias("last"), F.count("*").alias("n")).drop("__run")


def forward_fill(df: DataFrame, by: list[str], value: str, order: list[str], name: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def suppress_repeats(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """Null where a cell, all cells left of it and the keys equal those of the row before, in the order of the whole table."""
    moved = with_previous(df, order, [*keys, *columns])
    same = F.col("previous").isNotNull()
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"previous.{k}"))
    shown = {}
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"previous.{c}"))
        shown[c] = F.when(~same, F.col(c)).alias(c)
    return moved.select(*[shown.get(c, F.col(c)) for c in df.columns])


def running_depth(df: DataFrame, by: list[str], step: Column, order: list[str], name: str) -> DataFrame:
    """Sum of steps (+1 opens, -1 closes) up to and with each row."""
    return df.withColumn(name, F.sum(step).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).cast("long"))


def priority_union(parts: list[DataFrame], keys: list[str], order: list[str]) -> DataFrame:
    """Rows of all parts, one a key: of the first part that has it, there the first in order."""
    whole = None
    for k, p in enumerate(parts):
        p = p.withColumn("__prio", F.lit(k))
        whole = p if whole is None else whole.unionByName(p)
    return keep_first(whole, keys, ["__prio", *order]).drop("__prio")


def unpivot(df: DataFrame, ids: list[str], columns: list[str]) -> DataFrame:
    """ids, level (from 1), cell."""
    cells = F.array(*[F.struct(F.lit(k).alias("level"), F.col(c).cast("string").alias("cell")) for k, c in enumerate(columns, 1)])
    return df.select(*ids, F.inline(cells))
