"""Shapes of the physical plans that matter at scale."""

import pytest

import __spark_entry__ as spark_entry
from helpers import silver_traffic
from kerbside.operators import layers, scoring, training
from kerbside.plans import batch, feeds
from kerbside.schemas import TRAFFIC
from kerbside.sources.datasets import read_silver
from test_scoring import START, train

PLAIN = ["unified_events", "kpi_1m", "alert_summary", "training_pairs", "parse_faults"]


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(spark_entry.queries()[name](spark, sf_dir))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize("name", PLAIN)
def test_feed_filter_and_columns_reach_the_scan(spark, sf_dir, name):
    plan = plan_of(spark_entry.queries()[name](spark, sf_dir))
    assert "PushedFilters: [In(event_type" in plan
    if name != "parse_faults":
        assert "event_id" not in plan


def test_text_is_parsed_once_a_row(spark, sf_dir):
    plan = plan_of(batch.silver(feeds.read_events(spark, sf_dir), "traffic").where("speed_kmh > 3"))
    assert plan.count("from_json(") == 1


def test_kpis_fold_before_their_only_exchange(spark, sf_dir):
    plan = plan_of(spark_entry.queries()["kpi_1m"](spark, sf_dir))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_avg" in plan and "partial_max" in plan


def test_layers_do_not_shuffle(spark, sf_dir):
    messages = feeds.messages(feeds.read_events(spark, sf_dir), "traffic")
    for rows in (
        layers.to_bronze(messages),
        layers.to_silver(messages, TRAFFIC),
        layers.to_rejects(messages, TRAFFIC),
    ):
        assert "Exchange" not in plan_of(rows)


def test_training_join_adds_no_exchange_to_its_two_aggregates(spark, sf_dir):
    events = feeds.read_events(spark, sf_dir)
    hours = training.paired_hours(*[batch.silver(events, f) for f in ("traffic", "pollution")])
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(hours)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert plan.count("partial_count") == 2


def test_scoring_does_not_shuffle(spark, sf_dir):
    kpi = batch.kpi(feeds.read_events(spark, sf_dir), "1 hour")
    scored = plan_of(scoring.score(kpi, train(spark)))
    assert scored.count("Exchange") == plan_of(kpi).count("Exchange")


def test_training_reads_only_its_columns_of_the_history(spark, folder):
    silver_traffic(spark, [("Centre", START, 40, 4)]).write.partitionBy("district").parquet(
        f"{folder}/traffic"
    )
    rows = training.traffic_hours(read_silver(spark, f"{folder}/traffic", "traffic"))
    plan = plan_of(rows)
    columns = "speed_kmh:int,vehicle_count:int,event_time:timestamp"
    assert f"ReadSchema: struct<{columns}>" in plan
    assert "PartitionFilters: [isnotnull(district" in plan
    for column in ("event_time", "speed_kmh", "vehicle_count"):
        assert f"IsNotNull({column})" in plan[plan.index("PushedFilters") :]
