"""Physical-plan guards: what must never appear in a registered query's plan."""

import pytest

from dwspark.plans import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


# The tables whose scans are split among all tasks: no query deals them out anew before it works.
LARGER = "/root/testdata/sf0.1"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The model queries train a tree while being built; their plans are ML transforms, not joins.
@pytest.mark.parametrize("name", sorted(n for n in catalog.queries() if not n.startswith(("l2_", "l5_", "l6_"))))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = plan_of(catalog.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans a {op}"


def test_change_counting_is_hash_aggregated(spark):
    plan = plan_of(catalog.queries()["c2_change_counts"](spark, SF))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_scans_are_pruned_and_filtered(spark):
    plan = plan_of(catalog.queries()["c2_change_counts"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    plan = plan_of(catalog.queries()["a1_order_item_summary"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in plan


@pytest.mark.parametrize("name", ["q1_table_shapes", "q7_profile", "w11_car_sales", "j7_order_lines", "c2_change_counts"])
def test_no_round_robin_shuffle(spark, name):
    assert "RoundRobinPartitioning" not in plan_of(catalog.queries()[name](spark, LARGER))


def test_building_w11_runs_no_job(spark):
    spark.sparkContext.setJobGroup("w11", "build")
    catalog.queries()["w11_car_sales"](spark, SF)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("w11")
    # Opening a Parquet table reads its schema (one job a table); nothing else runs.
    assert len(jobs) <= 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
