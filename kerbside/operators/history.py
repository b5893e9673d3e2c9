"""Plain SQL over the cleaned history."""

from kerbside.operators.packing import read_history
from kerbside.schemas import SILVER
from kerbside.sources.datasets import read_silver


def register(spark, paths, packed=None):
    """Name the silver datasets ``silver_traffic`` and ``silver_pollution`` for ``spark.sql``.

    ``packed``: folders of packed history by feed, which then counts with the live datasets.
    """
    for feed in SILVER:
        if feed in paths:
            old = (packed or {}).get(feed)
            rows = read_history(spark, paths[feed], old, feed) if old else read_silver(spark, paths[feed], feed)
            rows.createOrReplaceTempView(f"silver_{feed}")
