"""Versioned marts: a build writes a new version, readers switch when its checks have passed.

Layout below the output folder::

    versions/<id>/<model>/      the tables of one build, never written again
    versions/<id>/_dq_report/   its check report
    published/                  one JSON file a publication: version, id, and each model's path

A publication is a single row appended by Spark's committer, so readers see it whole or
not at all.  ``Published`` resolves models through the newest one.  A build that fails, or whose
checks fail, leaves the earlier publication and its tables as they were.  A build of some models
publishes these and, for the rest, the paths of the version before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.plans.ordering import in_declared_order

SCHEMA = "version long, id string, models map<string,string>"


class ChecksFailed(RuntimeError):
    """Declared checks failed on a new version, which was not published; ``failures`` are (model, column, test, count)."""

    def __init__(self, failures: list[tuple], path: str):
        self.failures, self.path = failures, path
        super().__init__("; ".join(f"{m}.{c} {t}: {n}" for m, c, t, n in failures) + f" (in {path}, not published)")


def _manifests(spark: SparkSession, out_dir: str) -> DataFrame | None:
    folder = f"{out_dir.rstrip('/')}/published"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(SCHEMA).json(folder)


def current(spark: SparkSession, out_dir: str) -> dict | None:
    """The newest publication (version, id, models), None before the first."""
    found = _manifests(spark, out_dir)
    row = found.orderBy(F.col("version").desc(), F.col("id").desc()).first() if found is not None else None
    return row.asDict() if row else None


def new_version(out_dir: str) -> str:
    """The folder of a new version; its name is its own, so a repeated build meets no files of a failed one."""
    return f"{out_dir.rstrip('/')}/versions/{uuid.uuid4().hex}"


def commit(spark: SparkSession, out_dir: str, folder: str, models: Iterable[str]) -> dict:
    """Make ``folder``'s models the published ones; other models keep the paths they had."""
    before = current(spark, out_dir) or {"version": 0, "models": {}}
    paths = dict(before["models"]) | {m: f"{folder}/{m}" for m in models}
    row = {"version": before["version"] + 1, "id": folder.rsplit("/", 1)[1], "models": paths}
    spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").json(f"{out_dir.rstrip('/')}/published")
    return row


class Published:
    """Reads the published marts of a folder; all reads of one instance come from one version."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.manifest = spark, current(spark, out_dir)
        if self.manifest is None:
            raise FileNotFoundError(f"nothing is published in {out_dir}")

    def read(self, model: str, ordered: bool = True) -> DataFrame:
        """A mart, in the order it declares (if any) unless ``ordered`` is off."""
        df = self.spark.read.parquet(self.manifest["models"][model])
        return in_declared_order(df, model) if ordered else df
