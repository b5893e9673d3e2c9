"""Bronze and silver rows. The same functions serve batch and stream."""

from pyspark.sql import functions as F

from kerbside.functions.parsing import decode, is_reject, observe_quality, parse


def to_bronze(messages):
    """The payload untouched as text, with the time and UTC day it came in."""
    now = F.current_timestamp()
    return decode(messages).select(
        F.col("json").alias("json_payload"),
        now.alias("ingestion_time"),
        F.date_format(now, "yyyy-MM-dd").alias("ingestion_date"),
    )


def to_silver(messages, schema, metrics=None):
    """Typed events. Messages without one readable field are left to ``to_rejects``.

    ``metrics`` names the quality counts to observe.
    """
    rows = parse(decode(messages), schema)
    if metrics:
        rows = observe_quality(rows, schema, metrics)
    return rows.where(~is_reject(schema)).drop("json", "timestamp")


def to_rejects(messages, schema):
    """The raw text of what ``to_silver`` leaves out, with the reason."""
    return (
        parse(decode(messages), schema)
        .where(is_reject(schema))
        .select(
            "json",
            F.when(F.col("json").isNull(), "null message")
            .otherwise("no readable field")
            .alias("reason"),
        )
    )


def with_day(silver):
    """A date column for a second partition level, where districts alone grow too large."""
    return silver.withColumn("event_date", F.to_date("event_time"))


def pack(rows, rows_per_file=5_000_000):
    """Silver rows in files of similar size, for history a stream wrote as many small ones.

    Ranges are cut by time within a district, so one busy district still spreads over many
    tasks, and by row number within a time, so copies of one event do as well. With a date
    column, rows are sorted by it before the time, as a second partition level wants them.
    """
    days = ["event_date"] if "event_date" in rows.columns else []
    files = 1 + rows.count() // rows_per_file
    return (
        rows.withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(files, "district", "event_time", "row")
        .sortWithinPartitions("district", *days, "event_time")
        .drop("row")
    )
