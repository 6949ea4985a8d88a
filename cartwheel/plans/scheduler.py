"""Concurrent Spark jobs over a dependency graph.

Every task runs Spark actions from its own thread, in its own FAIR pool (where the
session schedules fairly), so the short stages of one model fill the cores that another
leaves idle.  The number of threads is bounded.  A task starts when all it needs has
succeeded; a failed one stops only those that need it, directly or through others.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

THREADS = 4


@dataclass
class Outcome:
    """What became of a task: ``state`` is done, failed or skipped (``because`` of a task it needs)."""
    state: str
    seconds: float = 0.0
    value: object = None
    error: BaseException | None = None
    because: str | None = None


class GraphError(ValueError):
    """The needs of the tasks form a cycle or name a task that does not exist."""


def levels(needs: Mapping[str, Iterable[str]]) -> list[str]:
    """The names in an order in which each comes after all it needs (as declared, where that is free)."""
    left = {k: set(v) for k, v in needs.items()}
    if unknown := set().union(*left.values(), set()) - set(left):
        raise GraphError(f"unknown: {sorted(unknown)}")
    order: list[str] = []
    while left:
        ready = [k for k, v in left.items() if not v]
        if not ready:
            raise GraphError(f"cycle among {sorted(left)}")
        order += ready
        left = {k: v - set(ready) for k, v in left.items() if k not in ready}
    return order


def run_graph(spark: SparkSession, tasks: Mapping[str, Callable[[], object]], needs: Mapping[str, Iterable[str]] | None = None,
              threads: int = THREADS, log: Callable[[str], None] | None = None) -> dict[str, Outcome]:
    """Run every task once all it needs (among the tasks) is done; never raises for a task's own error."""
    needs = {k: {n for n in (needs or {}).get(k, ()) if n in tasks} for k in tasks}
    waiting = {k: set(needs[k]) for k in levels(needs)}
    outcomes: dict[str, Outcome] = {}
    running: dict[Future, str] = {}

    def call(name: str):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        t0 = time.time()
        try:
            return Outcome("done", value=tasks[name](), seconds=round(time.time() - t0, 3))
        except Exception as e:  # reported in the outcome; the tasks that need this one are skipped
            return Outcome("failed", error=e, seconds=round(time.time() - t0, 3))

    def settle(name: str, outcome: Outcome) -> None:
        outcomes[name] = outcome
        if log:
            log(f"{name}: {outcome.state}" + (f" in {outcome.seconds}s" if outcome.state == "done" else f" ({outcome.error or outcome.because})"))
        for other in list(waiting):
            if name in waiting.get(other, ()):
                waiting[other].discard(name)
                if outcome.state != "done":
                    del waiting[other]
                    settle(other, Outcome("skipped", because=name))

    with ThreadPoolExecutor(max_workers=threads, thread_name_prefix="cartwheel") as pool:
        while waiting or running:
            for name in [k for k, v in waiting.items() if not v]:
                del waiting[name]
                running[pool.submit(inheritable_thread_target(spark)(call), name)] = name
            done, _ = wait(running, return_when=FIRST_COMPLETED)
            for future in done:
                settle(running.pop(future), future.result())
    return outcomes


class TasksFailed(RuntimeError):
    """Some tasks failed; ``outcomes`` has all of them."""

    def __init__(self, outcomes: dict[str, Outcome]):
        self.outcomes = outcomes
        failed = [f"{k}: {o.error}" for k, o in outcomes.items() if o.state == "failed"]
        skipped = [f"{k} (needs {o.because})" for k, o in outcomes.items() if o.state == "skipped"]
        super().__init__("; ".join(["failed: " + ", ".join(failed)] + (["skipped: " + ", ".join(skipped)] if skipped else [])))


def require_done(outcomes: dict[str, Outcome]) -> dict[str, Outcome]:
    """The outcomes, if all are done."""
    if any(o.state != "done" for o in outcomes.values()):
        cause = next((o.error for o in outcomes.values() if o.error), None)
        raise TasksFailed(outcomes) from cause
    return outcomes
