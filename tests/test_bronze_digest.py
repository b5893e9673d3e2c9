"""The digest of ``bronze_ingest`` is that of all stored lines of a sensor, in order."""

import hashlib
from collections import defaultdict
from datetime import datetime, timedelta

from kerbside.plans import feeds, streams


def test_digest_of_ordered_lines(spark, folder):
    day = datetime(2024, 1, 1)
    rows = [(i, day + timedelta(seconds=i * 37 % 500), None if i % 10 == 9 else i % 2, "view" if i % 3 else "purchase", float(i % 7 * 20), f'{{"k": {i % 60}}}') for i in range(400)]
    rows += rows[:50]  # the same messages once more
    spark.createDataFrame(rows, feeds.EVENTS).coalesce(1).write.parquet(f"{folder}/events.parquet")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # a sensor's lines come in many batches
    try:
        got = {(r.feed, r.sensor_id): (r.messages, r.payloads) for r in streams.bronze_ingest(spark, folder).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    lines = defaultdict(list)
    for feed in streams.FEEDS:
        fields = dict(feeds.payload_fields(feed))
        for r in feeds.of_feed(feeds.read_events(spark, folder), feed).select(*(fields[name].cast("string").alias(name) for name in streams.FIELDS[feed])).collect():
            lines[feed, r.sensor_id].append("|".join(x for x in r if x is not None))
    assert len(got) == len(lines) == 6
    assert got == {key: (len(found), hashlib.md5("\n".join(sorted(found)).encode()).hexdigest()) for key, found in lines.items()}
