"""Shapes of physical plans that matter at scale."""

import pytest

from registry.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def plan_of(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["w1_latest_rank", "d1_latest_in_batch", "d3_first_wins_across", "d4_first_wins_all", "a1_region_hourly_stats"])
def test_newest_row_is_picked_before_the_shuffle(spark, name):
    assert "Partial" in plan_of(spark, name) and "WindowGroupLimit" in plan_of(spark, name)


@pytest.mark.parametrize("name", ["f9_key_in", "p4_flatten_strict", "p5_flatten_lenient", "x3_region_text", "p10_geo_point", "k5_bulk_payload_latest"])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_one_shuffle_per_step(spark):
    # The snapshot by id, then the statistics by hour and region.
    assert plan_of(spark, "a1_region_hourly_stats").count("Exchange hashpartitioning") == 2
    # Both sides of the merge are already partitioned by id.
    assert plan_of(spark, "j1_latest_merge").count("Exchange hashpartitioning") == 2
    for name in ("f9_key_in", "x13_json_parse", "k5_bulk_payload_latest", "a10_map_points"):
        assert plan_of(spark, name).count("Exchange") <= 1


def test_unused_columns_are_not_read(spark):
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan_of(spark, "a2_chunk_metrics")
