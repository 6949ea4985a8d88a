"""Model registry and the per-build context that resolves ``ref(name)``.

A model is a function ``(ctx) -> DataFrame`` registered under a name.  The
context memoizes each resolved model, so within one job a model that feeds
several others is one DataFrame (one plan subtree, shared exchanges).  The
build job (``pipeline.build_all``) replaces resolved models by their written
tables, which cuts lineage between layers.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartwheel import DEFAULT_AS_OF

MODELS: dict[str, Callable[["ModelContext"], DataFrame]] = {}
LAYERS: dict[str, str] = {}


def model(name: str, layer: str):
    def register(fn):
        MODELS[name] = fn
        LAYERS[name] = layer
        return fn
    return register


class ModelContext:
    def __init__(self, spark: SparkSession, sources: Callable[[str], DataFrame],
                 as_of: str | dt.date = DEFAULT_AS_OF, params: dict | None = None):
        self.spark = spark
        self.sources = sources
        self.as_of = str(as_of)
        self.params = dict(params or {})
        self._resolved: dict[str, DataFrame] = {}
        self.materialized: set[str] = set()
        #: Failures of checks that a build has counted already, by (model, column, test).
        self.observed: dict[tuple[str, str, str], int] = {}

    def source(self, name: str) -> DataFrame:
        return self.sources(name)

    def ref(self, name: str) -> DataFrame:
        if name not in self._resolved:
            if name not in MODELS:
                raise KeyError(f"unknown model {name!r}")
            self._resolved[name] = MODELS[name](self)
        return self._resolved[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Point ``ref(name)`` at ``df`` (e.g. the table the build wrote)."""
        self._resolved[name] = df
        self.materialized.add(name)

    def param(self, key: str, default):
        return self.params.get(key, default)
