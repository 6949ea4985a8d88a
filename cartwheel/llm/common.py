"""Helpers shared by the training-data operators.

Rows are identified by ``doc_id``; texts may be null (read as empty) unless an
operator says otherwise.  Operators read only the columns they name, so extra
columns of any name never clash with the ones they add.
"""

from __future__ import annotations

import gc
import sys
import uuid
from collections.abc import Callable

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import checkpoint_dir

#: Separators of words: space and the control characters from tab to carriage return.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here,
    and what was computed survives the loss of any executor."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


class Kept(dict):
    """Values of ``make(key)``, kept for the keys met lately: what a full generation held is
    looked up in the previous one before it is made anew, so at most twice ``limit`` are held."""

    def __init__(self, limit: int, make: Callable):
        super().__init__()
        self.limit, self.make, self.before = limit, make, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        self[key] = value
        return value


def worker_cache(name: str, make: Callable):
    """What ``make()`` returns, kept by the Python worker while the tasks it runs ask for it.

    Workers outlive stages, and an idle one holds its memory beside those at work: before something is
    made, what no task of the present stage has asked for is let go (outside tasks all is kept).
    """
    kept = sys.__dict__.setdefault("_cartwheel_llm_cache", {})
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if name not in kept:
        old = [k for k, (_, asked) in kept.items() if asked != stage] if task else []
        for k in old:
            del kept[k]
        if old:
            gc.collect()  # encoders refer to themselves
        kept[name] = make(), stage
    value, asked = kept[name]
    if asked != stage:
        kept[name] = value, stage
    return value
