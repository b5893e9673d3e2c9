"""Registered queries that run as plain batch plans."""

from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import kpis as kpi_ops
from kerbside.operators import layers, training
from kerbside.plans import feeds


def ntz(name):
    return F.col(name).cast("timestamp_ntz").alias(name)


def silver(events, feed):
    return layers.to_silver(feeds.messages(events, feed), schemas.PAYLOADS[feed])


def unified(events):
    return kpi_ops.unify_messages(*[feeds.messages(events, feed) for feed in schemas.PAYLOADS])


def kpi(events, width):
    return kpi_ops.kpis(unified(events), width)


def kpi_columns(rows):
    return rows.select(
        "district",
        ntz("window_end"),
        "avg_speed",
        "max_density",
        "avg_pm25",
        "alert_level",
        "has_pm25",
    )


def unified_events(spark, sf_dir):
    events = feeds.read_events(spark, sf_dir)
    return unified(events).select("district", ntz("time"), "speed_kmh", "density", "pm25")


def kpi_query(width):
    return lambda spark, sf_dir: kpi_columns(kpi(feeds.read_events(spark, sf_dir), width))


def alert_summary(spark, sf_dir):
    return (
        kpi(feeds.read_events(spark, sf_dir), "1 hour")
        .groupBy("district", "alert_level")
        .agg(F.count(F.lit(1)).alias("windows"))
    )


def training_pairs(spark, sf_dir):
    events = feeds.read_events(spark, sf_dir)
    hours = training.paired_hours(silver(events, "traffic"), silver(events, "pollution"))
    return training.pair_totals(hours, "district")


def _faulty_messages(events, feed):
    """The feeds misbehaving: the event type decides what is wrong with a message.

    Traffic: junk text, a count sent as text, or a fractional speed beside an unknown field.
    Pollution: an unreadable time, or no message at all where the value is low.
    """
    fields = feeds.payload_fields(feed)
    kind = F.col("event_type")
    junk = F.concat(F.lit("not json "), F.col("event_id").cast("string")).cast("binary")
    if feed == "traffic":
        fraction = {**fields, "speed_kmh": F.col("value") + 0.5, "extra": F.lit(1)}
        text = {**fields, "vehicle_count": fields["vehicle_count"].cast("string")}
        value = (
            F.when(kind == "error", junk)
            .when(kind == "click", feeds.to_message(text))
            .otherwise(feeds.to_message(fraction))
        )
    else:
        no_time = {**fields, "timestamp": F.lit("bad")}
        value = F.when(kind == "signup", feeds.to_message(no_time)).otherwise(
            F.when(F.col("value") > 50, feeds.to_message(fields))
        )
    return feeds.of_feed(events, feed).select(value.alias("value"))


def parse_rejects(spark, sf_dir):
    """Junk text and null messages, taken out of both feeds with their raw text."""
    events = feeds.read_events(spark, sf_dir)
    sides = [
        layers.to_rejects(_faulty_messages(events, feed), schema).select(
            F.lit(feed).alias("feed"), "json", "reason"
        )
        for feed, schema in schemas.PAYLOADS.items()
    ]
    return sides[0].unionByName(sides[1])


def parse_faults(spark, sf_dir):
    """The messages that stay: wrongly typed fields and bad times are null, the rest is kept."""
    events = feeds.read_events(spark, sf_dir)
    sides = [
        layers.to_silver(_faulty_messages(events, feed), schema).select(
            F.lit(feed).alias("feed"), "sensor_id", "district", ntz("event_time"), *measures
        )
        for (feed, schema), measures in zip(
            schemas.PAYLOADS.items(), (["speed_kmh", "vehicle_count"], ["pm25", "co2"])
        )
    ]
    return sides[0].unionByName(sides[1], allowMissingColumns=True)
