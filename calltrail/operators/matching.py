"""Many patterns at once in many cells, by automata of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of patterns in one automaton. More patterns go over the cells in further passes.
MOST_CHARS = 1 << 22


def contained(cells: DataFrame, stems: DataFrame, most_chars: int = MOST_CHARS) -> DataFrame:
    """cell, stem of all stems that are a part of a cell, each pair of texts once for each row of cells.

    Stems are dealt to shards of about most_chars characters by hash; a shard's stems become one automaton, past which
    all cells stream, so a cell costs its length and its hits, however short or frequent the stems are. Nothing is
    exploded and no cell moves. Null and empty stems are part of nothing, null cells hold nothing. cells: cell; stems: stem.
    """
    own = stems.select(F.col("stem").cast("string").alias("stem")).where("stem <> ''").distinct()
    total = own.agg(F.coalesce(F.sum(F.length("stem")), F.lit(0))).first()[0]
    shards = max(1, -(-total // most_chars))
    out = None
    for k in range(shards):
        found = own.where(F.pmod(F.xxhash64("stem"), F.lit(shards)) == k).collect() if total else []  # most_chars or so of them
        part = _pass(cells.select(F.col("cell").cast("string").alias("cell")), [r["stem"] for r in found])
        out = part if out is None else out.unionByName(part)
    return out


def _pass(cells: DataFrame, stems: list[str]) -> DataFrame:
    shared = cells.sparkSession.sparkContext.broadcast(stems)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = ahocorasick.Automaton()
        for s in shared.value:
            machine.add_word(s, s)
        machine.make_automaton()
        for batch in batches:
            texts = batch.column(0).to_pylist() if len(machine) else []
            pairs = [(t, s) for t in texts if t for s in dict.fromkeys(s for _, s in machine.iter(t))]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], names=["cell", "stem"])

    return cells.mapInArrow(run, "cell string, stem string")
