"""The concurrent build: dependency graph, failing models, checks seen by the writes, atomic publication."""

import threading

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cartwheel.plans import load_models, pipeline, publish, quality
from cartwheel.plans.context import LAYERS, MODELS, ModelContext
from cartwheel.plans.ordering import RESULT_ORDER, sort_columns
from cartwheel.plans.scheduler import GraphError, TasksFailed, levels, run_graph
from cartwheel.registry import context


def test_levels():
    assert levels({"a": (), "b": ("c",), "c": ("a",), "d": ()}) == ["a", "d", "c", "b"]
    with pytest.raises(GraphError):
        levels({"a": ("b",), "b": ("a",)})
    with pytest.raises(GraphError):
        levels({"a": ("nobody",)})


def test_a_failure_stops_only_what_needs_it(spark):
    done = []
    tasks = {k: (lambda k=k: done.append(k)) for k in "abcdef"}
    tasks["b"] = lambda: 1 / 0
    out = run_graph(spark, tasks, {"b": "a", "c": "b", "d": "c", "e": "a", "f": "ed"}, threads=2)
    assert {k: o.state for k, o in out.items()} == {"a": "done", "b": "failed", "c": "skipped", "d": "skipped", "e": "done", "f": "skipped"}
    assert sorted(done) == ["a", "e"] and isinstance(out["b"].error, ZeroDivisionError)
    assert out["c"].because == "b" and out["d"].because == "c"


def test_tasks_run_at_the_same_time_and_not_more_than_threads(spark):
    both, lock, now, most = threading.Barrier(3, timeout=30), threading.Lock(), [0], [0]

    def task():
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        both.wait()
        with lock:
            now[0] -= 1

    out = run_graph(spark, {f"t{k}": task for k in range(6)}, threads=3)
    assert all(o.state == "done" for o in out.values()) and most[0] == 3


def test_declared_needs_are_the_refs(spark):
    """What every written model reads, through views too, is what NEEDS says."""
    load_models()

    class Recording(ModelContext):
        def ref(self, name):
            self.seen.add(name)
            return super().ref(name)

    written = [m for m in MODELS if LAYERS[m] not in pipeline.VIEW_LAYERS]
    assert sorted(written) == sorted(pipeline.BUILD_ORDER)
    base = context(spark, SF_SMALL)
    shared = {m: base.ref(m) for m in MODELS}
    for name in written:
        ctx = Recording(spark, base.sources, base.as_of)
        ctx.seen = set()
        for other in written:
            if other != name:
                ctx.replace(other, shared[other])
        MODELS[name](ctx)
        assert {m for m in ctx.seen if m in written and m != name} == set(pipeline.NEEDS[name]), name


def test_observed_failures_equal_the_checks(spark):
    rows = [(1, "New"), (None, "Loyal"), (None, None)]
    for statuses in (rows, [*rows, (4, "Bad"), (5, "Bad"), (6, "Worse")]):
        df = spark.createDataFrame(statuses, "user_id long, customer_status string")
        seen = quality.Observed("fct_customer_orders")
        seen.attach(df).write.format("noop").mode("overwrite").save()
        found = seen.failures()
        want = {r.column_name: r.failures for r in quality.column_failures(
            df, ["user_id"], (), [("customer_status", quality.CUSTOMER_STATUSES)]).collect()}
        assert found[("fct_customer_orders", "user_id", "not_null")] == want["user_id"] == 2
        # distinct bad values are left to a read of the table
        assert found.get(("fct_customer_orders", "customer_status", "accepted_values"), want["customer_status"]) == want["customer_status"]


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("marts"))
    return out, pipeline.publish(context(spark, SF_SMALL), out)


def test_publish(spark, published):
    out, first = published
    reader = publish.Published(spark, out)
    assert reader.manifest["version"] == first["version"] == 1 and sorted(first["models"]) == sorted(pipeline.BUILD_ORDER)
    plain = context(spark, SF_SMALL)
    for name in ("fct_orders", "fct_returns", "fct_customer_retention"):
        assert sorted(map(str, reader.read(name).collect())) == sorted(map(str, plain.ref(name).collect()))
    report = spark.read.parquet(f"{out}/versions/{first['id']}/_dq_report").collect()
    assert sorted(map(tuple, report)) == sorted(map(tuple, quality.run_checks(plain).collect())) and len(report) == len(quality.CHECKS)


def test_readers_get_the_declared_order(spark, published):
    reader = publish.Published(spark, published[0])
    for name in RESULT_ORDER:
        stored = reader.read(name, ordered=False)
        keys = [c.lstrip("-") for c in RESULT_ORDER[name]]
        rows = [tuple(r) for r in reader.read(name).select(*keys).collect()]
        again = [tuple(r) for r in stored.orderBy(*sort_columns(name)).select(*keys).collect()]
        assert rows == again, name


def test_a_failing_check_leaves_the_published_version(spark, published):
    out, first = published

    class Broken(ModelContext):
        def ref(self, name):
            df = super().ref(name)
            return df.union(df.limit(1)) if name == "fct_returns" and name not in self.materialized else df

    good = context(spark, SF_SMALL)
    with pytest.raises(publish.ChecksFailed, match="fct_returns.product_id unique: 1"):
        pipeline.publish(Broken(spark, good.sources, good.as_of), out, models=["fct_returns"])
    reader = publish.Published(spark, out)
    assert reader.manifest["version"] == 1 and reader.manifest["id"] == first["id"]
    assert reader.read("fct_returns").count() == good.ref("fct_returns").count()


def test_a_failing_model_publishes_nothing(spark, published, monkeypatch):
    out, first = published

    def fails(ctx):
        raise RuntimeError("no such column")

    monkeypatch.setitem(MODELS, "fct_sessions", fails)
    with pytest.raises(TasksFailed, match="fct_sessions: no such column") as e:
        pipeline.publish(context(spark, SF_SMALL), out)
    states = {k: o.state for k, o in e.value.outcomes.items()}
    assert {k for k, s in states.items() if s == "skipped"} == {"fct_web_funnel", "fct_traffic_source_performance", "fct_browser_performance"}
    assert [k for k, s in states.items() if s == "failed"] == ["fct_sessions"] and states["fct_cohort_revenue"] == "done"
    assert publish.current(spark, out)["id"] == first["id"]


def test_some_models_are_published_over_the_rest(spark, published):
    """A build of some models reads and keeps the others of the version before; older readers keep theirs."""
    out, first = published
    old = publish.Published(spark, out)
    second = pipeline.publish(context(spark, SF_SMALL), out, models=["fct_daily_revenue", "fct_monthly_revenue"])
    assert second["version"] == 2 and second["models"]["fct_orders"] == first["models"]["fct_orders"]
    assert second["models"]["fct_daily_revenue"] != first["models"]["fct_daily_revenue"]
    new = publish.Published(spark, out)
    for name in ("fct_daily_revenue", "fct_monthly_revenue"):
        assert sorted(map(str, new.read(name).collect())) == sorted(map(str, old.read(name).collect()))


def test_nothing_published(spark, tmp_out):
    with pytest.raises(FileNotFoundError):
        publish.Published(spark, tmp_out)
