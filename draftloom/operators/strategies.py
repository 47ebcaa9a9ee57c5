"""Drafting strategies: named system prompts, identified by the hash of their text."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Strategy(NamedTuple):
    label: str
    system: str
    version: int
    prompt_id: str


class Strategies:
    """A registry of prompts by label; the caller fills it, from code or from a table (label, system, version)."""

    def __init__(self) -> None:
        self._known: dict[str, Strategy] = {}

    def register(self, label: str, system: str, version: int = 1) -> Strategy:
        s = self._known[label] = Strategy(label, system, version, hashlib.sha256(system.encode()).hexdigest()[:12])
        return s

    def load(self, table: DataFrame) -> None:
        """All rows of a short table; of a label that repeats the highest version."""
        for r in sorted(table.select("label", "system", "version").collect(), key=lambda r: r["version"]):
            self.register(r["label"], r["system"], r["version"])

    def resolve(self, label: str, system: str | None = None) -> Strategy:
        """The strategy of a label; a given prompt goes before the registry and has version 0."""
        if system is not None:
            return Strategy(label, system, 0, hashlib.sha256(system.encode()).hexdigest()[:12])
        if label not in self._known:
            raise ValueError(f"unknown strategy {label!r}; known: {', '.join(sorted(self._known)) or 'none'}")
        return self._known[label]

    def table(self, spark: SparkSession) -> DataFrame:
        """(prompt_id, prompt_label, prompt_version, system), as the prompt archive takes it."""
        return spark.createDataFrame([(s.prompt_id, s.label, s.version, s.system) for s in self._known.values()], "prompt_id string, prompt_label string, prompt_version int, system string")
