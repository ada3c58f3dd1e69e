"""Configuration of a language and application: named patterns and word lists, from a JSON file that Spark reads."""

from __future__ import annotations

import html
import json
import re
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from calltrail.functions.text import SKIP_WORDS, SYSTEM_METHODS, SYSTEM_QUALIFIERS

#: Word lists where a configuration has none.
DEFAULT_WORDS = {
    "SYSTEM_METHODS": SYSTEM_METHODS,
    "SYSTEM_QUALIFIERS": SYSTEM_QUALIFIERS,
    "control_keywords": SKIP_WORDS["calls"],
    "COLLECTION_TYPES": ("List", "Set", "Map", "Collection", "Queue", "Deque"),
    "PRIMITIVE": ("int", "long", "short", "byte", "char", "float", "double", "boolean", "void"),
    "DVT_FILES": (),
}


@dataclass
class Config:
    details: dict = field(default_factory=dict)
    patterns: dict = field(default_factory=dict)

    def pattern(self, name: str) -> str:
        """A named pattern in the JVM's syntax, entities decoded. A name that is not there is a KeyError, a bad pattern re.error."""
        found = self.patterns.get(name)
        if not isinstance(found, str):
            raise KeyError(f"no pattern {name!r} in the configuration")
        plain = html.unescape(found)
        re.compile(plain)
        named = re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", plain)
        return re.sub(r"\(\?P<(\w+)>", r"(?<\1>", named)

    def words(self, name: str) -> tuple[str, ...]:
        """A word list: the configured one, else the default; an unknown name is a KeyError."""
        return tuple(self.details[name]) if name in self.details else tuple(DEFAULT_WORDS[name])


def read_config(spark: SparkSession, path: str, language: str, application: str) -> Config:
    """Looks up Language > language > Application > application in one file; what is missing on the way is a KeyError."""
    files = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(files) != 1:
        raise ValueError(f"{path} is not one file")
    found = json.loads(files[0]["value"])
    for key in ("Language", language, "Application", application):
        found = found[key]
    return Config(found.get("Language_details", {}), found.get("Regex_Pattern", {}))
