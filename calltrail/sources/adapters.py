"""Languages behind one interface: an adapter turns a file into rows, and executors look it up by name."""

from __future__ import annotations

import importlib
import re
from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.sources import java


class LanguageAdapter(Protocol):
    """What a language provides. parse() may fail; fallback() finds what it can and does not fail."""

    extension: str

    def configure(self, **flags) -> None: ...

    def strip(self, text: str) -> str: ...

    def parse(self, path: str, text: str) -> list[dict]: ...

    def fallback(self, path: str, text: str) -> list[dict]: ...


class JavaAdapter:
    extension = ".java"

    def __init__(self) -> None:
        self.flags: dict = {}

    def configure(self, **flags) -> None:
        self.flags = {k: v for k, v in flags.items() if k == "accept_new_types"}

    def strip(self, text: str) -> str:
        return java.blanked(text)

    def parse(self, path: str, text: str) -> list[dict]:
        """The scanner has its own fallback, whose rows are marked."""
        return java.Scanner(path, text, **self.flags).run()

    def fallback(self, path: str, text: str) -> list[dict]:
        return []


class ScriptAdapter:
    """Calls with a number, in the scripts of pages."""

    extension = ".html"
    _CALL = re.compile(r"([a-z]+)\([0-9]+\)")

    def configure(self, **flags) -> None:
        pass

    def strip(self, text: str) -> str:
        return re.sub(r"<!--.*?(?:-->|\Z)", "", text, flags=re.DOTALL)

    def parse(self, path: str, text: str) -> list[dict]:
        return [{"path": path, "kind": "call", "name": f"{m[1]}()", "type": "sibling", "pos": m.start(), "fallback": False} for m in self._CALL.finditer(text)]

    def fallback(self, path: str, text: str) -> list[dict]:
        return []


#: Adapters by language, as module:class, so that a task imports only what it needs.
REGISTRY = {"java": "calltrail.sources.adapters:JavaAdapter", "script": "calltrail.sources.adapters:ScriptAdapter"}


def resolve(spec: str) -> LanguageAdapter:
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)()


def parse(files: DataFrame, language_col: str, path_col: str = "path", text_col: str = "text", registry: dict[str, str] | None = None, **flags) -> DataFrame:
    """Rows (java.SCHEMA) of all files. A file of an unknown language, or whose adapter fails, gives an error row and its fallback's rows."""
    known = registry or REGISTRY

    def rows_of(adapters: dict, path: str, text: str, language: str | None) -> list[dict]:
        if language not in known:
            return [{"path": path, "kind": "error", "name": f"no adapter for {language}", "fallback": True}]
        if language not in adapters:
            adapters[language] = resolve(known[language])
            adapters[language].configure(**flags)
        try:
            return adapters[language].parse(path, text)
        except Exception as e:
            return [{"path": path, "kind": "error", "name": f"{type(e).__name__}: {e}", "fallback": True}, *adapters[language].fallback(path, text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adapters: dict = {}
        for batch in batches:
            found = [r for path, text, language in zip(*(c.to_pylist() for c in batch.columns), strict=True) if text is not None for r in rows_of(adapters, path, text, language)]
            yield java.rows_to_batch(found)

    return files.select(F.col(path_col).cast("string"), F.col(text_col).cast("string"), F.col(language_col).cast("string")).mapInArrow(run, java.SCHEMA)
