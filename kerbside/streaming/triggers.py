"""When micro-batches run, and waiting for them."""

# Take everything that is there and stop: backfills and tests.
ONCE = "once"


def trigger(every):
    return {"availableNow": True} if every == ONCE else {"processingTime": every}


def wait(spark, *queries):
    """Wait for the given queries to end, or for any of the session's if none is given."""
    if not queries:
        spark.streams.awaitAnyTermination()
    for query in queries:
        query.awaitTermination()
