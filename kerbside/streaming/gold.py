"""KPIs of both feeds as a stream: closed windows, scored and handed to a sink.

The number of shuffle partitions is fixed by the checkpoint at the first start, so set
``spark.sql.shuffle.partitions`` for the job's lifetime before it.
"""

from threading import Event

from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kerbside.operators.kpis import kpis, unify_messages
from kerbside.operators.scoring import LatestModel, score, with_alert_predicted
from kerbside.operators.serving import append_to_store, run_of, upsert_batch
from kerbside.session import use_state_settings
from kerbside.streaming.triggers import trigger


def windows(
    traffic, pollution, width="1 minute", watermark="1 minute", per_feed=False, metrics=None, idle=None
):
    """KPI rows from two message streams. Each window comes out once, when it has closed."""
    return kpis(unify_messages(traffic, pollution, watermark, per_feed, metrics, idle), width)


def table_sink(path):
    """A sink takes rows, the batch's number and the id of the stream, which its checkpoint keeps."""
    runs = {}

    def write(rows, batch_id, stream_id):
        if stream_id not in runs:
            runs[stream_id] = run_of(rows.sparkSession, path, stream_id)
        upsert_batch(rows, batch_id, path, runs[stream_id])

    return write


def store_sink(fmt, **options):
    """For example ``store_sink("org.apache.spark.sql.cassandra", keyspace=..., table=...)``."""
    return lambda rows, batch_id, stream_id: append_to_store(rows, batch_id, fmt, **options)


def start_gold(kpi, sink, checkpoint, model_path=None, every="30 seconds", name=None):
    """Score each batch of closed windows with the newest model and pass it to ``sink``.

    Windows are stored without a prediction while there is no model, and with the alert that
    goes by the prediction. A checkpoint is required: without it a restart would lose the open
    windows. Batches without a closed window touch neither model nor sink.
    """
    use_state_settings(kpi.sparkSession)
    model = LatestModel(kpi.sparkSession, model_path) if model_path else None

    started, stream_id = Event(), []

    def handle(batch, batch_id):
        # Kept, or each look at the batch would read the feeds and fold them into windows once more.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if batch.isEmpty():
                return
            started.wait()
            scored = with_alert_predicted(score(batch, model.get() if model else None))
            sink(scored, batch_id, stream_id[0])
        finally:
            batch.unpersist()

    writer = (
        kpi.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .foreachBatch(handle)
    )
    if name:
        writer = writer.queryName(name)
    query = writer.start()
    stream_id.append(query.id)
    started.set()
    return query


def start_windows(kpi, path, checkpoint, every="30 seconds"):
    """Closed windows, unscored, as an exactly-once Parquet dataset."""
    use_state_settings(kpi.sparkSession)
    return (
        kpi.withColumn("window_start", F.col("window.start"))
        .drop("window")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .start()
    )
