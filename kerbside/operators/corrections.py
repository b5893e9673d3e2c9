"""Windows of the serving table brought up to date with events that came too late for the stream.

The stream leaves out events of windows it has closed, and the cleaned history keeps them. So the
windows of the history that differ from those served are written as a later run, which wins.
"""

from functools import reduce
from operator import or_
from uuid import uuid4

from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import kpis, scoring, serving

MEASURED = ["avg_speed", "max_density", "avg_pm25"]


def changed(windows, served):
    """The windows up to the newest one served, of a known district, whose measures are not those served."""
    newest = served.agg(F.max("window_end").alias("newest"))  # one row
    old = served.select(*(F.col(c).alias(f"_{c}") for c in [*schemas.SERVING_KEY, *MEASURED]))
    key = [F.col(c) == F.col(f"_{c}") for c in schemas.SERVING_KEY]
    differs = reduce(or_, [~F.col(f"_{c}").eqNullSafe(F.col(c)) for c in ["district", *MEASURED]])
    rows = windows.where(F.col("district").isNotNull()).join(F.broadcast(newest), F.col("window_end") <= F.col("newest"))
    return rows.join(old, key, "left").where(differs).select(*windows.columns)


def correct(spark, traffic, pollution, path, model=None, width="1 minute", since=None):
    """Write the windows that the history has otherwise, from the day ``since`` on; their number.

    A repeated call finds nothing more to write.
    """
    events = kpis.unify(traffic, pollution)
    if since is not None:
        events = events.where(F.col("time") >= F.lit(str(since)).cast("timestamp"))
    served = serving.current(spark, path, since=since)
    rows = changed(kpis.kpis(events, width), served)
    rows = scoring.with_alert_predicted(scoring.score(rows, model)).persist()
    try:
        count = rows.count()
        if count:
            serving.upsert_batch(rows, 0, path, serving.run_of(spark, path, f"corrections-{uuid4().hex}"))
        return count
    finally:
        rows.unpersist()
