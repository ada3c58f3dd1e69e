"""The cluster's shared folder, tables written there, slices of batches, and unused column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a new local one in local mode, as in tests; an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Cuts lineage with a written table in the shared folder, so a lost executor costs no earlier stage."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of materialize() that nothing reads any more: what came of them has been written."""
    for t in tables:
        drop_path(t.sparkSession, t.written_at)


def drop_path(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def unused(df: DataFrame, name: str) -> str:
    """The name, or one made of it, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_slices(batches: Iterator[pa.RecordBatch], size: int = 4 << 20, column: int = 1) -> Iterator[pa.RecordBatch]:
    """Smaller batches of about `size` bytes of a column, a row at least, so that few texts are Python strings at once."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
            yield batch.slice(at, end - at)
            at = end
