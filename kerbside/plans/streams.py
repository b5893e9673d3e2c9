"""Registered queries that run a stream over the tables to its end and read what it wrote."""

import hashlib
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import history, layers, packing
from kerbside.operators.commits import Log, Store
from kerbside.plans import feeds
from kerbside.plans.batch import kpi_columns, ntz
from kerbside.session import shuffle_partitions, workspace
from kerbside.sources.datasets import bronze_messages, read_bronze, read_silver
from kerbside.sources.topics import read_message_files
from kerbside.streaming.carry import carry, windows_from
from kerbside.streaming.gold import start_windows, windows
from kerbside.streaming.layers import start_bronze, start_rejects, start_silver
from kerbside.streaming.triggers import ONCE, wait

FEEDS = list(schemas.PAYLOADS)
# Payload fields whose text is the same in every JSON writer.
FIELDS = {
    "traffic": ["sensor_id", "district", "speed_kmh", "vehicle_count", "timestamp"],
    "pollution": ["sensor_id", "district", "pm25", "co2", "timestamp"],
}


def streamed_messages(spark, sf_dir, feed):
    return feeds.messages(feeds.stream_events(spark, sf_dir), feed)


def run_bronze(spark, sf_dir):
    """Both bronze datasets, written by two concurrent streams; their paths by feed."""
    root = workspace(spark, "bronze")
    paths = {feed: f"{root}/{feed}" for feed in FEEDS}
    wait(
        spark,
        *[
            start_bronze(
                streamed_messages(spark, sf_dir, feed), path, f"{root}/progress_{feed}", ONCE
            )
            for feed, path in paths.items()
        ],
    )
    return paths


def run_silver(spark, sf_dir, wanted=FEEDS):
    root = workspace(spark, "silver")
    paths = {feed: f"{root}/{feed}" for feed in wanted}
    wait(
        spark,
        *[
            start_silver(
                streamed_messages(spark, sf_dir, feed),
                schemas.PAYLOADS[feed],
                path,
                f"{root}/progress_{feed}",
                ONCE,
            )
            for feed, path in paths.items()
        ],
    )
    return paths


def _line_digests(rows):
    """``sensor_id`` and the md5 of each sensor's lines in order, joined by line feeds.

    Spark sorts the lines, on disk where they are many; a batch of them is held at a time.
    """

    def digests(batches):  # sent by value, as it is no name of a module
        sensor, digest = None, None

        def found():
            return pa.RecordBatch.from_pydict({"sensor_id": pa.array([sensor], pa.string()), "payloads": [digest.hexdigest()]})

        for batch in batches:
            for key, run in groupby(zip(*(c.to_pylist() for c in batch.columns), strict=True), itemgetter(0)):
                text = "\n".join(line for _, line in run).encode()
                if digest and key == sensor:
                    digest.update(b"\n" + text)
                    continue
                if digest:
                    yield found()
                sensor, digest = key, hashlib.md5(text)
        if digest:
            yield found()

    placed = rows.select("sensor_id", "line").repartition("sensor_id").sortWithinPartitions("sensor_id", "line")
    return placed.mapInArrow(digests, "sensor_id string, payloads string")


def bronze_ingest(spark, sf_dir):
    """Messages per feed and sensor in the bronze datasets as stored, with a digest of what they say."""
    paths = run_bronze(spark, sf_dir)

    def side(feed):
        rows = (
            read_bronze(spark, paths[feed])
            .select(
                F.lit(feed).alias("feed"),
                F.json_tuple("json_payload", *FIELDS[feed]).alias(*FIELDS[feed]),
                (F.to_date("ingestion_time") == F.to_date("ingestion_date")).alias("dated"),
            )
            .withColumn("line", F.concat_ws("|", *FIELDS[feed]))
        )
        counts = rows.groupBy("feed", "sensor_id").agg(
            F.count(F.lit(1)).alias("messages"),
            F.count_if("dated").alias("dated"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        )
        digests = _line_digests(rows).withColumnRenamed("sensor_id", "_sensor")
        return counts.join(digests, F.col("sensor_id").eqNullSafe(F.col("_sensor"))).drop("_sensor")

    return side("traffic").unionByName(side("pollution"))


def silver_from_bronze(spark, sf_dir):
    """Both cleaned feeds rebuilt from their stored raw payloads."""
    paths = run_bronze(spark, sf_dir)

    def side(feed):
        messages = bronze_messages(read_bronze(spark, paths[feed]))
        rows = layers.to_silver(messages, schemas.PAYLOADS[feed])
        return rows.withColumn("event_time", ntz("event_time"))

    return side("traffic").unionByName(side("pollution"), allowMissingColumns=True)


def silver_query(feed):
    def query(spark, sf_dir):
        rows = read_silver(spark, run_silver(spark, sf_dir, [feed])[feed], feed)
        return rows.withColumn("event_time", ntz("event_time"))

    return query


def silver_replayed(spark, sf_dir):
    """The pollution dataset of a stream that ended after its sink's commit and before its own, started again."""
    root = workspace(spark, "replay")

    def run():
        sent = streamed_messages(spark, sf_dir, "pollution")
        start_silver(sent, schemas.POLLUTION, f"{root}/rows", f"{root}/progress", ONCE).awaitTermination()

    run()
    progress = Store(spark, f"{root}/progress/commits")
    for name in progress.files_in(""):
        progress.remove(name)
    run()
    rows = read_silver(spark, f"{root}/rows", "pollution")
    return rows.withColumn("event_time", ntz("event_time"))


HISTORY_SQL = """
        SELECT t.district, CAST(t.hour AS TIMESTAMP_NTZ) AS hour, t.mean_speed, p.mean_pm25
        FROM (SELECT district, date_trunc('hour', event_time) AS hour, avg(speed_kmh) AS mean_speed
              FROM silver_traffic GROUP BY ALL) t
        JOIN (SELECT district, date_trunc('hour', event_time) AS hour, avg(pm25) AS mean_pm25
              FROM silver_pollution GROUP BY ALL) p
          ON t.district = p.district AND t.hour = p.hour
        """


def history_sql(spark, sf_dir):
    history.register(spark, run_silver(spark, sf_dir))
    return spark.sql(HISTORY_SQL)


def silver_in_halves(spark, sf_dir, then):
    """Silver datasets by feed whose stream was stopped and resumed; ``then(paths)`` is called after each run."""
    events, *parts = feeds.halves(spark, sf_dir)
    root = workspace(spark, "halves")
    paths = {feed: f"{root}/{feed}" for feed in FEEDS}
    for part in parts:
        for feed in FEEDS:
            feeds.messages(events.where(part), feed).write.mode("append").parquet(f"{root}/sent_{feed}")
        sent = {feed: read_message_files(spark, f"{root}/sent_{feed}") for feed in FEEDS}
        wait(spark, *[start_silver(sent[feed], schemas.PAYLOADS[feed], paths[feed], f"{root}/progress_{feed}", ONCE) for feed in FEEDS])
        then(paths)
    return paths


def history_packed(spark, sf_dir):
    """The same over packed and live history: traffic packed after each run of its stream, pollution after the first."""
    root = workspace(spark, "packed")
    packed = {feed: f"{root}/{feed}" for feed in FEEDS}

    def pack(paths):
        for feed in FEEDS:
            if feed == "traffic" or not Log(spark, packed[feed]).table().files:
                packing.pack(spark, paths[feed], packed[feed], feed, 20_000)

    history.register(spark, silver_in_halves(spark, sf_dir, pack), packed)
    return spark.sql(HISTORY_SQL)




WINDOWS = (
    "district string, avg_speed double, max_density int, avg_pm25 double, window_end timestamp, "
    "alert_level string, has_pm25 boolean, window_start timestamp"
)
SCORED_WINDOWS = f"{WINDOWS}, predicted_pm25 double"


def _closed_windows(spark, kpi):
    root = workspace(spark, "windows")
    start_windows(kpi, f"{root}/rows", f"{root}/progress", ONCE).awaitTermination()
    return kpi_columns(spark.read.schema(WINDOWS).parquet(f"{root}/rows"))


def stream_kpis(spark, sf_dir, width):
    return windows(*[streamed_messages(spark, sf_dir, feed) for feed in FEEDS], width=width)


def kpi_stream_query(width):
    return lambda spark, sf_dir: _closed_windows(spark, stream_kpis(spark, sf_dir, width))


def kpi_stream_two_watermarks(spark, sf_dir):
    """Windows wait for the slower feed: pollution ends on the day in the middle, traffic goes on."""
    _, early, _ = feeds.halves(spark, sf_dir)
    events = feeds.stream_events(spark, sf_dir)
    sides = [
        feeds.messages(events, "traffic"),
        feeds.messages(events.where(early), "pollution"),
    ]
    return _closed_windows(spark, windows(*sides, width="1 hour", per_feed=True))


def kpi_stream_idle(spark, sf_dir):
    """The same, but pollution counts as silent when it is two days behind: traffic windows go on."""
    _, early, _ = feeds.halves(spark, sf_dir)
    events = feeds.stream_events(spark, sf_dir)
    sides = [feeds.messages(events, "traffic"), feeds.messages(events.where(early), "pollution")]
    return _closed_windows(spark, windows(*sides, width="1 hour", per_feed=True, idle="2 days"))


def kpi_stream_late(spark, sf_dir):
    """A stream stopped and resumed, where the second run brings events that are long overdue.

    The first run sees all event types but two, the second only those two. Of these, what
    belongs to windows already closed is dropped; the rest joins the windows kept in state.
    """
    events = feeds.read_events(spark, sf_dir)
    overdue = F.col("event_type").isin("error", "signup")
    root = workspace(spark, "late")
    for part in (~overdue, overdue):
        for feed in FEEDS:
            feeds.messages(events.where(part), feed).write.mode("append").parquet(f"{root}/{feed}")
        kpi = windows(
            *[read_message_files(spark, f"{root}/{feed}") for feed in FEEDS], width="1 hour"
        )
        start_windows(kpi, f"{root}/rows", f"{root}/progress", ONCE).awaitTermination()
    return kpi_columns(spark.read.schema(WINDOWS).parquet(f"{root}/rows"))


def kpi_stream_carried(spark, sf_dir):
    """Windows of a stream on 8 partitions, and of one on 32 that went on with its open windows in the middle of an hour."""
    events, early, late = feeds.halves(spark, sf_dir, "30 minutes")
    root = workspace(spark, "carried")

    def sent(run, part):
        for feed in FEEDS:
            feeds.messages(events.where(part), feed).write.parquet(f"{root}/sent_{run}_{feed}")
        return [read_message_files(spark, f"{root}/sent_{run}_{feed}") for feed in FEEDS]

    def run(number, partitions, kpi):
        with shuffle_partitions(spark, partitions):
            start_windows(kpi, f"{root}/rows_{number}", f"{root}/progress_{number}", ONCE).awaitTermination()

    run(1, 8, windows(*sent(1, early), width="1 hour"))
    carry(spark, f"{root}/progress_1", f"{root}/open")
    run(2, 32, windows_from(f"{root}/open", *sent(2, late), width="1 hour"))
    # Each sink's own log tells which files count, so each is read by itself.
    parts = [spark.read.schema(WINDOWS).parquet(f"{root}/rows_{number}") for number in (1, 2)]
    return kpi_columns(parts[0].unionByName(parts[1]))


def reject_stream(spark, sf_dir):
    """Rejects of a stream: here the event properties are sent where a sensor message belongs."""
    root = workspace(spark, "rejects")
    sent = feeds.stream_events(spark, sf_dir).select(
        F.when(F.col("event_type") != "view", F.col("props")).cast("binary").alias("value")
    )
    start_rejects(
        sent, schemas.TRAFFIC, f"{root}/rows", f"{root}/progress", ONCE
    ).awaitTermination()
    return (
        spark.read.schema("json string, reason string")
        .json(f"{root}/rows")
        .groupBy("json", "reason")
        .agg(F.count(F.lit(1)).alias("messages"))
    )
