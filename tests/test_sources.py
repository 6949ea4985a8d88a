"""The parquet source path: models over stored sources equal models over the fixture adapter."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.functions import outward
from cartwheel.plans import load_models
from cartwheel.plans.context import ModelContext
from cartwheel.sources import FixtureSources, ParquetSources, SOURCES


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in outward(df).collect())


def test_models_over_parquet_sources_match_fixture(spark, tmp_out):
    load_models()
    fx = FixtureSources(spark, SF_SMALL)
    for name in SOURCES:
        fx(name).write.mode("overwrite").parquet(f"{tmp_out}/{name}")
    pq = ParquetSources(spark, tmp_out)
    for name, schema in SOURCES.items():
        assert pq(name).schema == schema
    a = ModelContext(spark, fx)
    b = ModelContext(spark, pq)
    for model in ["fct_orders", "fct_sessions", "dim_products", "fct_customer_retention"]:
        assert _rows(a.ref(model)) == _rows(b.ref(model)), model
    assert b.ref("stg_inventory_items").where(F.col("is_sold")).count() > 0
