"""The two sensor feeds, derived from the ``events`` table as JSON messages."""

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from kerbside.session import use_utc

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)

# The districts, and the event types that stand for the traffic feed.
DISTRICTS = ["Centre", "Nord", "Sud", "Est", "Ouest"]
TRAFFIC_TYPES = ["view", "click", "error"]
# In the feed with gaps, a field is missing where the event's number is divisible by this.
GAPS = {"district": 7, "timestamp": 11, "speed_kmh": 5, "vehicle_count": 3, "pm25": 4}


def read_events(spark, sf_dir):
    return use_utc(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark, sf_dir):
    # A file stream wants a folder or a pattern; this one matches just that table.
    return use_utc(spark).readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet")


def instant():
    return F.col("ts").cast("timestamp")


def halves(spark, sf_dir, after="0 minutes"):
    """Events, and conditions for those up to ``after`` the day in the middle begins and for the rest."""
    events = read_events(spark, sf_dir)
    middle = (F.unix_seconds(F.min(instant())) + F.unix_seconds(F.max(instant()))) / 2
    cut = events.select(F.date_trunc("day", F.timestamp_seconds(middle)).alias("cut")).first().cut
    cut = F.lit(cut) + F.expr(f"INTERVAL {after}")
    return events, instant() < cut, instant() >= cut


def of_feed(events, feed):
    traffic = F.col("event_type").isin(TRAFFIC_TYPES)
    return events.where(traffic if feed == "traffic" else ~traffic)


def _k():
    return F.get_json_object("props", "$.k").cast("int")


def district():
    return F.element_at(
        F.array(*[F.lit(name) for name in DISTRICTS]), (F.col("user_id") % 5 + 1).cast("int")
    )


def _sensor(prefix, count):
    return F.concat(F.lit(prefix), F.col("user_id") % count)


def payload_fields(feed):
    """The payload columns of one feed as (name, expression), in message order."""
    whole = F.floor("value")
    measures = (
        {
            "lat": 48.8 + _k() / 1000,
            "lon": 2.3 + _k() / 1000,
            "speed_kmh": (whole % 130).cast("int"),
            "vehicle_count": _k() % 50,
        }
        if feed == "traffic"
        else {"pm25": (whole % 100).cast("int"), "co2": 400 + _k() * 2 % 200}
    )
    return {
        "sensor_id": _sensor("cam_", 100) if feed == "traffic" else _sensor("air_", 50),
        "district": district(),
        **measures,
        "timestamp": F.date_format(
            F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
        ),
    }


def to_message(fields):
    """JSON bytes, as a broker delivers them."""
    payload = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.to_json(payload).cast("binary")


def messages_with_gaps(events, feed):
    fields = {
        name: F.when(F.col("event_id") % GAPS[name] != 0, value) if name in GAPS else value
        for name, value in payload_fields(feed).items()
    }
    return of_feed(events, feed).select(to_message(fields).alias("value"))


def messages(events, feed):
    return of_feed(events, feed).select(to_message(payload_fields(feed)).alias("value"))
