"""Plan shape checks: the scale properties the README claims."""

import pytest

from visitlens import registry
from conftest import SF_SMALL

BATCH = [n for n in registry.queries() if not n.startswith("st_")]


def _plan(spark, name):
    df = registry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loop_cartesian_or_python(spark, name):
    plan = _plan(spark, name)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
                "ExistingRDD"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["b7_top10_sessions", "b10_area_top3",
                                  "b10_area_top3_lineitem", "b15_province_top3"])
def test_top_n_has_partial_group_limit(spark, name):
    plan = _plan(spark, name)
    assert plan.count("WindowGroupLimit") >= 2, name  # partial before the exchange + final


@pytest.mark.parametrize("name", ["b4_session_sample", "b4_session_sample_all_days"])
def test_sample_ranks_digit_groups_only(spark, name):
    """No window gathers a stratum: rows are ranked within (day, hour, digits)."""
    ranked = [line for line in _plan(spark, name).splitlines() if "Window [row_number()" in line]
    assert ranked and all("_group" in line for line in ranked)


def test_page_conversion_slices_by_range_and_scans_once(spark):
    plan = _plan(spark, "b8_page_conversion")
    assert "rangepartitioning(session_id" in plan
    assert plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["b1_session_profile", "b8_page_conversion", "b10_area_top3"])
def test_date_range_reaches_the_scan(spark, name):
    plan = _plan(spark, name)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan, name
