"""Bronze, silver and reject datasets as streaming file sinks.

Each call starts one query on one feed; a session runs as many as there are feeds. The file
sink commits whole micro-batches, so restarts neither lose nor repeat a message. No query
shuffles: tasks write what they read, whatever district it is for.
"""

from kerbside import schemas
from kerbside.operators import moments
from kerbside.operators.layers import to_bronze, to_rejects, to_silver, with_day
from kerbside.streaming.triggers import trigger


def _start(rows, fmt, path, checkpoint, partitions, every, name):
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def start_bronze(messages, path, checkpoint, every="10 seconds", name=None):
    return _start(to_bronze(messages), "json", path, checkpoint, ["ingestion_date"], every, name)


def start_silver(
    messages, schema, path, checkpoint, every="10 seconds", name=None, metrics=None, by_day=False
):
    """``by_day`` adds a date level below the district folders."""
    rows = to_silver(messages, schema, metrics)
    partitions = ["district"]
    if by_day:
        rows, partitions = with_day(rows), ["district", "event_date"]
    return _start(rows, "parquet", path, checkpoint, partitions, every, name)


def start_rejects(messages, schema, path, checkpoint, every="10 minutes", name=None):
    return _start(to_rejects(messages, schema), "json", path, checkpoint, [], every, name)


def start_moments(spark, silver, feed, path, checkpoint, every="1 minute", name=None):
    """Add new events of a silver dataset to the sums that training takes; no event is read twice."""
    rows = spark.readStream.schema(schemas.SILVER[feed]).parquet(silver)
    writer = (
        rows.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger(every))
        .foreachBatch(lambda batch, batch_id: moments.add_batch(batch, batch_id, path, feed, checkpoint))
    )
    if name:
        writer = writer.queryName(name)
    return writer.start()
