"""Parsing, bronze and silver: edge messages, datasets and their layout."""

import datetime
import glob
import os
import threading
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import messages, pollution, send, stamp, traffic
from kerbside import schemas, session
from kerbside.operators import history, layers
from kerbside.session import workspace
from kerbside.sources.datasets import bronze_messages, read_bronze, read_silver
from kerbside.sources.topics import read_message_files, read_topic
from kerbside.streaming.layers import start_bronze, start_rejects, start_silver
from kerbside.streaming.triggers import ONCE, trigger, wait

EDGE = [
    pollution(),
    "not json",
    None,
    "{}",
    pollution(pm25=12.7),
    pollution(pm25="9"),
    pollution(extra=1),
    {**pollution(), "timestamp": "bad"},
    pollution(time=None),
    pollution(district=None),
]


def test_silver_rows(spark):
    rows = layers.to_silver(messages(spark, EDGE), schemas.POLLUTION).collect()
    assert [row.pm25 for row in rows] == [30, None, None, 30, 30, 30, 30]
    assert [row.co2 for row in rows] == [420] * 7
    assert [row.event_time is None for row in rows] == [False] * 4 + [True, True, False]
    assert rows[6].district is None
    assert rows[0].asDict().keys() == {"sensor_id", "district", "pm25", "co2", "event_time"}


def test_rejects_are_what_silver_leaves_out(spark):
    rows = layers.to_rejects(messages(spark, EDGE), schemas.POLLUTION).collect()
    assert {(row.json, row.reason) for row in rows} == {
        ("not json", "no readable field"),
        (None, "null message"),
        ("{}", "no readable field"),
    }


def test_event_time_is_utc_with_fractions(spark):
    rows = layers.to_silver(
        messages(spark, [{**traffic(), "timestamp": "2024-01-01T00:00:07.179575Z"}]),
        schemas.TRAFFIC,
    )
    text = rows.select(F.col("event_time").cast("string")).first()[0]
    assert text == "2024-01-01 00:00:07.179575"


def test_bronze_rows(spark):
    row = layers.to_bronze(messages(spark, ["anything"])).first()
    assert row.json_payload == "anything"
    assert row.ingestion_date == f"{row.ingestion_time:%Y-%m-%d}"


def test_bronze_dataset(spark, folder):
    send(spark, EDGE, f"{folder}/feed")
    start_bronze(
        read_message_files(spark, f"{folder}/feed"), f"{folder}/out", f"{folder}/progress", ONCE
    ).awaitTermination()
    stored = read_bronze(spark, f"{folder}/out")
    assert stored.schema.simpleString() == schemas.BRONZE.simpleString()
    assert stored.count() == len(EDGE)
    today = stored.first().ingestion_date
    assert glob.glob(f"{folder}/out/ingestion_date={today}/*.json")
    assert read_bronze(spark, f"{folder}/out", today).count() == len(EDGE)
    assert read_bronze(spark, f"{folder}/out", "1999-01-01").count() == 0
    # The payload is text inside the stored object, so later layers can be rebuilt from it.
    rebuilt = layers.to_silver(bronze_messages(stored), schemas.POLLUTION)
    direct = layers.to_silver(messages(spark, EDGE), schemas.POLLUTION)
    assert sorted(map(str, rebuilt.collect())) == sorted(map(str, direct.collect()))


def test_restart_neither_loses_nor_repeats(spark, folder):
    for count in (3, 2):
        send(spark, [traffic()] * count, f"{folder}/feed")
        start_bronze(
            read_message_files(spark, f"{folder}/feed"), f"{folder}/out", f"{folder}/progress", ONCE
        ).awaitTermination()
    assert read_bronze(spark, f"{folder}/out").count() == 5


def test_silver_dataset_rejects_and_metrics(spark, folder):
    send(spark, EDGE, f"{folder}/feed")

    def feed():
        return read_message_files(spark, f"{folder}/feed")

    silver = start_silver(
        feed(), schemas.POLLUTION, f"{folder}/out", f"{folder}/p1", ONCE, metrics="quality"
    )
    rejects = start_rejects(feed(), schemas.POLLUTION, f"{folder}/bad", f"{folder}/p2", ONCE)
    wait(spark, silver, rejects)
    stored = read_silver(spark, f"{folder}/out", "pollution")
    assert stored.columns == schemas.SILVER_POLLUTION.names
    assert stored.count() == 7
    assert sorted(path.rsplit("/", 1)[1] for path in glob.glob(f"{folder}/out/district=*")) == [
        "district=Centre",
        "district=__HIVE_DEFAULT_PARTITION__",
    ]
    counts = silver.lastProgress.observedMetrics["quality"]
    assert (counts.messages, counts.rejected, counts.untimed) == (10, 3, 5)
    assert spark.read.json(f"{folder}/bad").count() == 3


def test_silver_by_day_and_numeric_looking_district(spark, folder):
    send(spark, [traffic(district="007"), traffic(district="7")], f"{folder}/feed")
    start_silver(
        read_message_files(spark, f"{folder}/feed"),
        schemas.TRAFFIC,
        f"{folder}/out",
        f"{folder}/progress",
        ONCE,
        by_day=True,
    ).awaitTermination()
    assert glob.glob(f"{folder}/out/district=007/event_date=2024-01-01/*.parquet")
    stored = read_silver(spark, f"{folder}/out", "traffic")
    assert sorted(row.district for row in stored.collect()) == ["007", "7"]


def test_text_source(spark, folder):
    with open(f"{folder}/lines.txt", "w") as lines:
        lines.write('{"district": "Nord"}\njunk\n')
    query = start_bronze(
        read_message_files(spark, folder, "text", pathGlobFilter="*.txt"),
        f"{folder}/out",
        f"{folder}/progress",
        ONCE,
    )
    query.awaitTermination()
    assert {row.json_payload for row in read_bronze(spark, f"{folder}/out").collect()} == {
        '{"district": "Nord"}',
        "junk",
    }


def test_broker_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, "traffic-raw", "broker:9092", maxOffsetsPerTrigger="1000")


def test_live_trigger_and_waiting_for_any(spark, folder):
    send(spark, [traffic()] * 3, f"{folder}/feed")
    spark.streams.resetTerminated()
    query = start_bronze(
        read_message_files(spark, f"{folder}/feed"),
        f"{folder}/out",
        f"{folder}/progress",
        "1 second",
        "live",
    )
    assert query.isActive and query.name == "live"
    query.processAllAvailable()
    threading.Timer(0.5, query.stop).start()
    wait(spark)
    assert not query.isActive
    assert read_bronze(spark, f"{folder}/out").count() == 3


def test_triggers():
    assert trigger(ONCE) == {"availableNow": True}
    assert trigger("10 seconds") == {"processingTime": "10 seconds"}


@pytest.mark.parametrize("step", [1, 0])
def test_pack_splits_one_district_and_copies_of_one_event(spark, step):
    start = F.lit(datetime.datetime(2024, 1, 1)).cast("timestamp")
    rows = spark.range(1000).select(
        F.lit("Centre").alias("district"),
        (start + F.make_dt_interval(secs=F.col("id") * step)).alias("event_time"),
    )
    packed = layers.pack(rows, 300)
    sizes = packed.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 4 and max(size["count"] for size in sizes) < 500
    assert packed.columns == rows.columns
    assert packed.count() == 1000


def test_history_sql_prunes(spark, folder):
    send(spark, [traffic(), traffic(district="Nord", speed=70)], f"{folder}/feed")
    start_silver(
        read_message_files(spark, f"{folder}/feed"),
        schemas.TRAFFIC,
        f"{folder}/out",
        f"{folder}/progress",
        ONCE,
    ).awaitTermination()
    history.register(spark, {"traffic": f"{folder}/out"})
    rows = spark.sql("SELECT avg(speed_kmh) AS v FROM silver_traffic WHERE district = 'Nord'")
    assert rows.first().v == 70
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "(district" in plan[plan.index("PartitionFilters") :]
    assert "ReadSchema: struct<speed_kmh:int>" in plan


class Session:
    """As much of a session as the working folder asks for."""

    def __init__(self, master, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda name, default: folder or default)


def test_workspace_is_shared_and_fresh(spark):
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first != second and first.startswith(session.shared_folder(spark))
    cluster = Session("spark://host:7077", "hdfs://shared/work/")
    assert workspace(cluster, "x").startswith("hdfs://shared/work/x-")


def test_workspace_without_a_setting(monkeypatch):
    monkeypatch.setattr(session, "_local_folder", None)
    for master in ("local", "local[8]", "local[*]"):
        assert os.path.isdir(os.path.dirname(workspace(Session(master), "x")))
    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            workspace(Session(master), "x")
    own = session._local_folder
    session.remove_local_folder()
    assert not os.path.exists(own)


def test_stamp_helper():
    assert stamp("00:00:10") == "2024-01-01T00:00:10.000Z"
