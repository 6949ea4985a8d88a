"""Sources: the seven e-commerce tables, from parquet or from the driver fixtures.

A source set is any callable ``name -> DataFrame`` over the names in
``schemas.SOURCES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources.fixtures import FixtureSources
from cartwheel.sources.schemas import SOURCES


class ParquetSources:
    """Sources stored as ``<root>/<name>`` parquet datasets.

    The stored types may be the documented ones (integer ids, floating-point money) or
    our own: columns are read as they are stored and cast to ``SOURCES`` here, at the edge.
    Money becomes an exact decimal, so that sums do not depend on their order.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        if name not in SOURCES:
            raise KeyError(f"unknown source {name!r}")
        stored = self.spark.read.parquet(f"{self.root}/{name}")
        missing = [c for c in SOURCES[name].names if c not in stored.columns]
        if missing:
            raise ValueError(f"source {name} lacks {', '.join(missing)}")
        return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCES[name]])


__all__ = ["FixtureSources", "ParquetSources", "SOURCES"]
