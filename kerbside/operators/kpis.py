"""Both feeds on one shape, and their KPIs per time window and district."""

from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.functions.parsing import decode, observe_quality, parse
from kerbside.functions.rules import alert_level


def traffic_events(rows):
    return rows.select(
        "district",
        F.col("event_time").alias("time"),
        "speed_kmh",
        F.col("vehicle_count").alias("density"),
        F.lit(None).cast("int").alias("pm25"),
    )


def pollution_events(rows):
    return rows.select(
        "district",
        F.col("event_time").alias("time"),
        F.lit(None).cast("int").alias("speed_kmh"),
        F.lit(None).cast("int").alias("density"),
        "pm25",
    )


def with_idle_watermark(events, watermark, others, idle):
    """A watermark on ``events`` that moves on while they are silent and ``others(time)`` are not.

    The other feed's times less ``idle`` pass through the watermark as rows of their own and are
    left out right behind it, so it follows the newest of both. The comparison that leaves them
    out names the event time, hence the optimizer keeps it above the watermark.
    """
    beats = others.select((F.col("time") - F.expr(f"INTERVAL {idle}")).alias("time"))
    marked = events.withColumn("own_time", F.col("time")).unionByName(beats, allowMissingColumns=True)
    kept = marked.withWatermark("time", watermark).where(F.col("own_time").eqNullSafe(F.col("time")))
    return kept.drop("own_time")


def unify(traffic, pollution, watermark=None, per_feed=False, idle=None, clocks=None):
    """All events of both feeds, each padded with nulls for what only the other measures.

    One ``watermark`` over the merged stream follows the faster feed, so a stalled feed
    loses rows. ``per_feed`` sets one on each side: the slower feed then decides, and a
    stopped feed holds the output back. With ``idle``, such as "10 minutes", a feed that far
    behind the other counts as silent, and the output goes on at that distance; what it sends
    later for windows that are out by then is late. This reads each feed a second time, for its
    times only; ``clocks`` are these readings, of both feeds, where the given rows don't serve.
    """
    left, right = traffic_events(traffic), pollution_events(pollution)
    if watermark and per_feed and idle:
        left_times, right_times = [rows.select(F.col("event_time").alias("time")) for rows in clocks or (traffic, pollution)]
        left, right = (
            with_idle_watermark(left, watermark, right_times, idle),
            with_idle_watermark(right, watermark, left_times, idle),
        )
    elif watermark and per_feed:
        left, right = left.withWatermark("time", watermark), right.withWatermark("time", watermark)
    merged = left.unionByName(right)
    if watermark and not per_feed:
        merged = merged.withWatermark("time", watermark)
    return merged


def unify_messages(traffic, pollution, watermark=None, per_feed=False, metrics=None, idle=None):
    """``unify`` from raw messages, parsing no more than the KPIs need.

    With ``metrics`` the quality counts of each feed are observed as ``<metrics>_<feed>``;
    events without a time, which no window takes, are among them.
    """
    sides = []
    for feed, messages in (("traffic", traffic), ("pollution", pollution)):
        schema = schemas.KPI_PAYLOADS[feed]
        rows = parse(decode(messages), schema)
        sides.append(observe_quality(rows, schema, f"{metrics}_{feed}") if metrics else rows)
    clocks = [parse(decode(messages), schemas.CLOCK) for messages in (traffic, pollution)] if idle else None
    return unify(*sides, watermark, per_feed, idle, clocks)


def kpis(events, width="1 minute"):
    """One row per tumbling window and district; events without a time belong to none.

    Each task first folds its rows to one per window and district, so the exchange carries
    as many rows as there are groups, however many events a district has.
    """
    groups = events.groupBy(F.window("time", width), "district")
    return kpi_measures(groups, F.avg("speed_kmh"), F.max("density"), F.avg("pm25"))


def kpi_measures(groups, avg_speed, max_density, avg_pm25):
    """The KPI columns of rows grouped by window and district."""
    return groups.agg(
        avg_speed.alias("avg_speed"), max_density.alias("max_density"), avg_pm25.alias("avg_pm25")
    ).withColumns(
        {
            "window_end": F.col("window.end"),
            "alert_level": alert_level(F.col("avg_pm25")),
            "has_pm25": F.col("avg_pm25").isNotNull(),
        }
    )
