"""From message bytes to typed columns. Bad input becomes nulls, never an error."""

from functools import reduce
from operator import and_

from pyspark.sql import functions as F


def decode(messages):
    """Only the message value is used; it arrives as bytes (or text from a file source)."""
    return messages.select(F.col("value").cast("string").alias("json"))


def parse(decoded, schema):
    """Payload fields next to the raw text, plus the event time.

    A field of the wrong type is null and leaves its neighbours alone; text that is no JSON
    object gives nulls throughout. ``try_to_timestamp`` keeps one bad message from stopping
    a stream under ANSI mode.

    The struct is expanded with ``inline`` rather than ``data.*``: a filter on a field would
    be pushed below a plain projection and parse the text once more for every field it names.
    Nothing prunes the schema for us then, so callers pass just the fields they use.
    """
    return decoded.select(
        "json", F.inline(F.array(F.from_json("json", schema)))
    ).withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))


def is_reject(schema):
    """True when not one payload field could be read."""
    return reduce(and_, [F.col(name).isNull() for name in schema.names])


def observe_quality(rows, schema, name):
    """Count all, unreadable and untimed messages on their way, at no extra pass.

    A stream reports the counts of each micro-batch as ``observedMetrics`` under ``name``.
    """
    return rows.observe(
        name,
        F.count(F.lit(1)).alias("messages"),
        F.count_if(is_reject(schema)).alias("rejected"),
        F.count_if(F.col("event_time").isNull()).alias("untimed"),
    )
