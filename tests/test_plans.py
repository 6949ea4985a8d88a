"""Plan-shape guards for the scale properties (read from ``explain()`` output)."""

import contextlib
import io
import re

import pytest

from conftest import SF_SMALL
from cartwheel.registry import all_queries


def physical(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    body = text.split("== Physical Plan ==", 1)[-1]
    return [ln for ln in body.splitlines() if ln.strip()]


@pytest.fixture(scope="module")
def plans(spark):
    q = all_queries()
    return lambda key: physical(q[key](spark, SF_SMALL))


def test_global_windows_only_over_range_statistics(plans):
    for key in ("dim_products", "fct_rfm_scores", "win_ntile_global"):
        lines = plans(key)
        for i, ln in enumerate(lines):
            if "Exchange SinglePartition" in ln:
                below = " ".join(lines[i + 1:i + 3])
                # a total (one partial row a task), or the statistics of the ranges
                assert re.search(r"HashAggregate\(keys=\[(\]|_pid)", below), (key, ln)


def test_first_order_flag_has_no_window(plans):
    assert not any(re.search(r"\bWindow\b", ln) for ln in plans("fct_orders"))


def test_cohort_grid_is_generated_after_its_exchange(plans):
    lines = plans("fct_customer_cohorts")
    smj = [i for i, ln in enumerate(lines) if "SortMergeJoin" in ln]
    gen = [i for i, ln in enumerate(lines) if "Generate explode" in ln]
    assert smj and gen
    # joined on user and month, on the users' own partitioning
    assert re.search(r"SortMergeJoin \[user_id#\d+L, activity_month#\d+\], \[_o_user#\d+L, _o_month#\d+\]", lines[smj[0]])
    # nothing reshuffles the exploded grid before the join
    assert not any("Exchange" in ln for ln in lines[smj[0] + 1:gen[0]])
    # and the window reuses the join's partitioning
    win = [i for i, ln in enumerate(lines) if re.search(r"\bWindow\b", ln)]
    assert win and not any("Exchange" in ln for ln in lines[win[0]:smj[0]])


def test_cohort_filter_reaches_the_users(plans):
    lines = plans("cohort_retention_lookup")
    gen = max(i for i, ln in enumerate(lines) if "Generate explode" in ln)
    assert any("Filter" in ln and "2020-01" in ln for ln in lines[gen:])


def test_sessions_have_one_shuffle_and_no_ranking(plans):
    lines = plans("fct_sessions")
    assert sum("Exchange" in ln for ln in lines) == 1
    assert not any("RDDScan" in ln or "ExistingRDD" in ln for ln in lines)


def test_daily_revenue_has_one_distinct(plans):
    assert not any(re.search(r"\bExpand\b", ln) for ln in plans("fct_daily_revenue"))


def test_retention_counts_without_distinct_expand(plans):
    assert not any(re.search(r"\bExpand\b", ln) for ln in plans("fct_customer_retention"))
