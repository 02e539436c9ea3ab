"""Physical-plan checks: column pruning at the scan, one shuffle for the wide adapter. That no registered query has
a cross product is checked where all of them run, in test_oracles."""

import pytest

from conftest import SMALL

from slotcast.plans import registry

registry.load_all()
QUERIES = dict(registry.QUERIES)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_adapter_prunes_and_shuffles_once(spark):
    p = plan_of(QUERIES["slot_sales_wide"](spark, SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_calendar_join_is_broadcast(spark):
    p = plan_of(QUERIES["calendar_features"](spark, SMALL))
    assert "BroadcastHashJoin" in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", ["grid_interval", "grid_day", "calendar_features", "level_rollup_hour", "level_rollup_day_total"])
def test_grids_scan_events_once(spark, name):
    """The grid is built from one written table; the raw events do not appear in the final plan."""
    assert "events.parquet" in plan_of(QUERIES["slot_sales_wide"](spark, SMALL))
    assert "events.parquet" not in plan_of(QUERIES[name](spark, SMALL))
