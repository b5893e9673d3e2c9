"""Going on with the open windows of a stopped gold stream under another checkpoint.

A checkpoint keeps its first number of shuffle partitions and its source's kind. ``carry`` writes
the open windows' sums and the watermark that the stopped stream had reached as a small dataset;
a new stream takes it as one more source in its first micro-batch. The stopped stream should have
ended between two micro-batches, as it does with ``--once``: a batch that reached the sink and not
the checkpoint comes once more, which the serving table takes in place and a file sink would repeat.
"""

from pyspark.sql import functions as F

from kerbside.operators.kpis import kpi_measures, unify_messages

CARRIED = (
    "district string, time timestamp, own_time timestamp, since timestamp, speed_sum long, speed_count long, "
    "density int, pm25_sum long, pm25_count long"
)
SUMS = {"speed_sum": "long", "speed_count": "long", "density": "int", "pm25_sum": "long", "pm25_count": "long"}


def _last_batch(spark, checkpoint):
    """Number, watermark and source positions of the last batch that was committed."""
    state = spark.read.format("state-metadata").load(checkpoint).first()
    if state is None:
        raise ValueError(f"{checkpoint} has no window state")
    lines = [row.value for row in spark.read.text(f"{checkpoint}/offsets/{state.maxBatchId}").collect()]
    told = spark.range(1).select(F.get_json_object(F.lit(lines[1]), "$.batchWatermarkMs").cast("long")).first()[0]
    return state.maxBatchId, told, lines[2:]


def carry(spark, checkpoint, path, watermark="1 minute"):
    """Write the open windows of a stopped stream to ``path``; the positions its sources had come to.

    For a topic these have the form of its ``startingOffsets``. ``watermark`` is the delay of the
    stopped stream. Null districts are a group like others; without open windows only the
    watermark is carried. The state is read where it lies, by as many tasks as it has partitions.
    """
    batch, reached, positions = _last_batch(spark, checkpoint)
    state = spark.read.format("statestore").option("batchId", batch).load(checkpoint)
    # The state names two fields "sum" and two "count"; the cast goes by place and names them apart.
    sums = F.col("value").cast(f"struct<{', '.join(f'{name}: {kind}' for name, kind in SUMS.items())}>")
    rows = state.select("key.window", "key.district", sums.alias("sums"))
    since = F.timestamp_millis(F.lit(reached))
    rows = rows.select(
        "district", F.col("window.start").alias("time"), F.col("window.start").alias("own_time"),
        since.alias("since"), "sums.*",
    )
    newest = since + F.expr(f"INTERVAL {watermark}")
    clock = spark.range(1).select(newest.alias("time"), since.alias("since"))
    rows.unionByName(clock, allowMissingColumns=True).write.parquet(path)
    return positions


def windows_from(carried, traffic, pollution, width="1 minute", watermark="1 minute", metrics=None):
    """KPI rows from two message streams and the windows in ``carried``, of the same ``width``.

    Windows the stopped stream has given out don't come again: events for them are late here as
    they were there. One watermark over both feeds, from where the stopped stream's was.
    """
    spark = traffic.sparkSession
    since = spark.read.schema(CARRIED).parquet(carried).agg(F.unix_micros(F.max("since"))).first()[0]
    events = unify_messages(traffic, pollution, metrics=metrics).select(
        "district", "time", F.col("time").alias("own_time"),
        F.col("speed_kmh").cast("long").alias("speed_sum"), F.col("speed_kmh").isNotNull().cast("long").alias("speed_count"),
        "density",
        F.col("pm25").cast("long").alias("pm25_sum"), F.col("pm25").isNotNull().cast("long").alias("pm25_count"),
    )
    before = spark.readStream.schema(CARRIED).parquet(carried).drop("since")
    rows = (
        events.unionByName(before)
        .withWatermark("time", watermark)
        # The clock's row has moved the watermark and is no event.
        .where(F.col("own_time").eqNullSafe(F.col("time")))
        .withColumn("window", F.window("time", width))
        .where(F.col("window.end") > F.timestamp_micros(F.lit(since)))
    )

    def mean(name):
        return F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_count"), F.lit(0))

    return kpi_measures(rows.groupBy("window", "district"), mean("speed"), F.max("density"), mean("pm25"))
