"""What the plans must look like at any size: no pairing of everything with everything, scans
that read only what they need, and hot keys cut before they are shuffled."""

import re

import pytest

import __spark_entry__ as entry_points
from selvatrace.plans import catalogue
from selvatrace.sources import roles

FOLDER = "/root/testdata/sf0.001"
BATCH = sorted(n for n in entry_points.queries() if not n.startswith("stream"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def without_broadcast(spark):
    """As on tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", BATCH)
def test_no_nested_loops(spark, without_broadcast, name):
    df = entry_points.queries()[name](spark, FOLDER)
    plan = plan_of(df)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # "!" marks a node that lacks a column it needs, which fails only at run time.
    assert not re.search(r"^[\s:+-]*!", df._jdf.queryExecution().optimizedPlan().toString(), re.M)
    if name in catalogue.queries():  # text operators may use Python inside their tasks
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(catalogue.loss_after_cutoff(spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "EqualTo(l_returnflag,R)" in plan


@pytest.mark.parametrize("name", ["latest_version", "dedup_alerts", "top_alerts", "review_sample", "best_composite"])
def test_top_rows_are_cut_in_the_map_tasks(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, FOLDER))
    assert re.search(r"WindowGroupLimit.*Final[\s\S]*Exchange[\s\S]*WindowGroupLimit.*Partial", plan)


def test_confirmed_source_is_reduced_before_it_is_copied(spark, without_broadcast):
    plan = plan_of(catalogue.confirm_alerts(spark, FOLDER))
    assert plan.index("Generate explode") < plan.rindex("partial_min(ts")


def test_rollup_copies_only_sums(spark):
    plan = plan_of(catalogue._QUERIES["admin_rollup"](spark, FOLDER))
    assert plan.index("Expand") < plan.index("HashAggregate(keys=[admin1", plan.index("Expand"))


def test_ordered_scans_shuffle_full_rows_once(spark, without_broadcast):
    whole = plan_of(entry_points.queries()["asof_state"](spark, FOLDER))
    assert whole.count("Exchange") == 1 and "Join" not in whole
    cut = plan_of(entry_points.queries()["asof_state_split"](spark, FOLDER))
    wide = [line for line in cut.splitlines() if "Exchange hashpartitioning(plot_id" in line and "_chunk" in line]
    assert len(wide) == 2  # the rows themselves, and one row per key and chunk


def test_events_hold_distinct_times(spark):
    alerts = roles.alerts(spark, FOLDER)
    assert alerts.select("ts").distinct().count() == alerts.count()


@pytest.mark.parametrize("how", ["inner", "left", "semi", "anti"])
def test_a_cell_hot_with_points_is_split_at_run_time(spark, without_broadcast, how):
    from pyspark.sql import functions as F

    from selvatrace.operators import spatial

    hot = F.col("id") % 3 == 0
    place = [F.when(hot, 0.05).otherwise(F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 100) for s in (1, 2)]
    points = spark.range(0, 120_000, 1, 8).select("id", place[0].alias("lon"), place[1].alias("lat"))
    plots = roles.plots(spark, FOLDER).select(
        "plot_id", F.transform("rings", lambda r: F.transform(r, lambda v: F.struct((v.x + 65).alias("x"), (v.y + 35).alias("y")))).alias("rings")
    )
    small = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        joined = spatial.pip_join(points, plots, 0.1, how)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
