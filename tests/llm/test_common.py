import sys

import pyarrow as pa

from cartwheel.llm.common import worker_cache


def test_a_stage_lets_go_what_earlier_stages_kept(spark):
    def held_by(name):
        def run(batches):
            for _ in batches:
                worker_cache(name, list)
                worker_cache(f"{name}, too", list)
                yield pa.record_batch([pa.array([sorted(sys.__dict__["_cartwheel_llm_cache"])])], ["held"])

        rows = spark.range(0, 16, 1, 16).mapInArrow(run, "held array<string>").collect()
        return {tuple(r.held) for r in rows}

    assert held_by("first") == {("first", "first, too")}
    assert held_by("second") == {("second", "second, too")}


def test_values_are_made_once(spark):
    def run(batches):
        for _ in batches:
            first, again = worker_cache("once", object), worker_cache("once", object)
            yield pa.record_batch([pa.array([first is again])], ["same"])

    assert all(r.same for r in spark.range(0, 4, 1, 4).mapInArrow(run, "same boolean").collect())
    assert worker_cache("outside tasks", list) is worker_cache("outside tasks", list)
