"""Plan checks: filters reach the scan, place filters prune partitions,
no Python UDF runs in any registered query, size-checked broadcasts."""

import pytest

import __spark_entry__ as E
from plan_text import plan_text
from skyframe.plans.registry import dwd
from skyframe.operators import query as Q

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")
# queries whose construction writes or streams (checked separately)
SIDE_EFFECT = {"stream_ingest"}


@pytest.mark.parametrize("name", sorted(set(E.queries()) - SIDE_EFFECT))
def test_no_python_in_plan(spark, sf_dir, name):
    plan = plan_text(E.queries()[name](spark, sf_dir), "extended")
    assert not any(n in plan for n in PYTHON_NODES), name


def test_period_prefix_pushed_to_parquet(spark, sf_dir):
    d = Q.in_period(dwd(spark, sf_dir), "1996-05")
    plan = plan_text(d)
    assert "StringStartsWith(year_mon_day,1996-05)" in plan


def test_place_prunes_partitions(spark, sf_dir):
    d = Q.in_district(dwd(spark, sf_dir), "ASIA区")
    plan = plan_text(d)
    assert "PartitionFilters: [isnotnull(district" in plan and "(district" in plan and "= ASIA)" in plan


def test_projection_pruned_at_scan(spark, sf_dir):
    d = Q.select_fields(dwd(spark, sf_dir), "ASIA区", "1996", ["最高温"])
    plan = plan_text(d)
    scan = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scan and all("weather" not in line and "wind" not in line for line in scan)


def test_dimension_lookup_is_broadcast(spark, sf_dir):
    plan = plan_text(E.queries()["url_lookup"](spark, sf_dir))
    assert "BroadcastHashJoin" in plan


def test_map_timeline_does_not_collect_frames(spark, sf_dir):
    plan = plan_text(E.queries()["map_timeline"](spark, sf_dir), "extended")
    assert "collect_list" not in plan and "collect_set" not in plan


def test_first_per_key_combines_map_side(spark, sf_dir):
    plan = plan_text(E.queries()["dedupe"](spark, sf_dir), "extended")
    assert "partial_min" in plan


def test_batch_rules_use_no_window(spark, sf_dir):
    plan = plan_text(E.queries()["batch_atomic"](spark, sf_dir), "extended")
    assert "windowspecdefinition" not in plan


def test_dead_letter_has_no_per_user_window(spark, sf_dir):
    plan = plan_text(E.queries()["dead_letter"](spark, sf_dir), "extended")
    assert "windowspecdefinition(user_id" not in plan
    # every slice goes to a task of its own: one exchange, by the slice's number
    assert plan.count("Exchange hashpartitioning") == 0 and "_pid" in plan
