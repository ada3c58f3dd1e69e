"""Shared helpers: table reads, digests, what workers keep; those of the library are used as they are."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from calltrail.operators.shared import discard, drop_path, in_slices, materialize, new_path, shared_dir, unused


__all__ = ["Memo", "discard", "drop_path", "ids_and_texts", "in_slices", "materialize", "new_path", "numbered_words", "shared_dir", "table", "text_digest", "unused", "worker_state"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_digest(text: str | Column) -> Column:
    """Identity of a text; null and the empty text are one."""
    col = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.substring(F.sha2(F.coalesce(col.cast("string"), F.lit("")), 256), 1, 32))


def ids_and_texts(batch: pa.RecordBatch) -> tuple[list, list[str]]:
    """First column as it is, second as str with null as the empty text."""
    return batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]


def numbered_words(texts: pa.Array, between: str = " ") -> tuple[pa.Array, pa.DictionaryArray]:
    """What stands between separators: a list for each text, and all words in a row as numbers of a dictionary."""
    split = pc.split_pattern(texts, between)
    return split, split.flatten().dictionary_encode()


_STATE: dict = {}


def _give_back() -> None:
    """Returns freed memory to the system, where the allocators can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_state(key, make: Callable):
    """What a Python worker keeps between tasks of one kind; it goes when a task of another kind asks for its own."""
    if key not in _STATE:
        _STATE.clear()
        _give_back()
        _STATE[key] = make()
    return _STATE[key]


class Memo(dict):
    """Results by key for one Python worker, in two generations so that memory stays bounded.

    A key found in the old generation moves to the young one; when the young one is full it becomes the old one. Keys
    over 96 characters are not kept.
    """

    def __init__(self, compute, limit: int = 300_000):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(key) <= 96:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found

    def forget(self, keys: Iterable) -> None:
        for k in keys:
            self.pop(k, None)
            self.old.pop(k, None)
