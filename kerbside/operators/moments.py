"""Training without reading history again: exact sums per district and hour, kept up to date.

All measures are whole numbers, so counts, sums, squares and products are too. They add up
exactly and in any order: a micro-batch of new events becomes one small file of sums, and the
moments of an hour are those of the sums of all its files.
"""

from uuid import uuid4

from pyspark.sql import functions as F

from kerbside.operators import training
from kerbside.operators.commits import Log

MEASURES = {"traffic": ["speed_kmh", "vehicle_count"], "pollution": ["pm25"]}
SHORT = {"speed_kmh": "speed", "vehicle_count": "vehicle", "pm25": "pm25"}


def _products(feed):
    """Name and factors of each sum."""
    names = MEASURES[feed]
    return {f"{SHORT[a]}_{SHORT[b]}": (a, b) for i, a in enumerate(names) for b in names[i:]} | {f"{SHORT[a]}_sum": (a,) for a in names}


def schema(feed):
    return "district string, hour timestamp, n long, " + ", ".join(f"{name} decimal(38,0)" for name in _products(feed))


def sums(rows, feed):
    """One row of exact sums per district and hour of the complete events."""
    wide = {m: F.col(m).cast("decimal(10,0)") for m in MEASURES[feed]}
    products = {
        name: F.sum(wide[factors[0]] * wide[factors[-1]] if len(factors) == 2 else wide[factors[0]]).cast("decimal(38,0)")
        for name, factors in _products(feed).items()
    }
    return training.complete_hours(rows, *MEASURES[feed]).groupBy(training.HOUR).agg(F.count(F.lit(1)).alias("n"), *(v.alias(k) for k, v in products.items()))


def added(rows, feed):
    """Sums of sums."""
    return rows.groupBy(training.HOUR).agg(F.sum("n").alias("n"), *(F.sum(name).cast("decimal(38,0)").alias(name) for name in _products(feed)))


def hours(rows, feed):
    """The moments of each hour, as ``training`` has them from the events."""
    n = F.col("n")

    def spread(a, b):  # exact up to the division
        a, b, both = F.col(f"{a}_sum"), F.col(f"{b}_sum"), F.col(f"{a}_{b}")
        return ((n.cast("decimal(19,0)") * both).cast("decimal(38,0)") - (a * b).cast("decimal(38,0)")).cast("double") / n / n

    found = [n.alias(f"n_{feed}")]
    for m in MEASURES[feed]:
        s = SHORT[m]
        total = F.col(f"{s}_sum")
        found += [total.cast("long").alias(f"{s}_sum"), (total.cast("double") / n).alias(f"{s}_mean"), spread(s, s).alias(f"{s}_var")]
    if feed == "traffic":
        found.append(spread("speed", "vehicle").alias("covar"))
    return added(rows, feed).select(*training.HOUR, *found)


def _own(table, feed):
    return [name for name, f in table.files.items() if f["feed"] == feed]


def read_sums(spark, path, feed):
    names = [f"{path}/{name}" for name in _own(Log(spark, path).table(), feed)]
    return spark.read.schema(schema(feed)).parquet(*names) if names else spark.createDataFrame([], schema(feed))


def _write(rows, log, feed, **entry):
    folder = f"data/{uuid4().hex}"
    rows.coalesce(1).write.parquet(f"{log.store.path}/{folder}")  # a row per district and hour of the events
    return {f"{folder}/{name}": {"feed": feed} | entry for name in log.store.files_in(folder) if name.endswith(".parquet")}


def add_batch(rows, batch_id, path, feed, stream):
    """Add the sums of a micro-batch, in place of what the same one left before."""
    log = Log(rows.sparkSession, path)
    files = _write(sums(rows, feed), log, feed, stream=stream, batch_id=batch_id)

    def change(table):
        same = [name for name in _own(table, feed) if (table.files[name]["stream"], table.files[name]["batch_id"]) == (stream, batch_id)]
        return {"add": files, "remove": same}

    log.commit(change)


def merge(spark, path, feed):
    """Put all files of a feed into one, a row per district and hour; the batches that come meanwhile stay as they are.

    Only files of batches before the newest of their stream are taken, as that one may be written again.
    """
    log = Log(spark, path)
    while True:
        table = log.table()
        own = {name: table.files[name] for name in _own(table, feed)}
        newest = {}
        for f in own.values():
            newest[f["stream"]] = max(newest.get(f["stream"], -1), f["batch_id"])
        taken = [name for name, f in own.items() if f["stream"] is None or f["batch_id"] < newest[f["stream"]]]
        if len(taken) < 2:
            return
        rows = spark.read.schema(schema(feed)).parquet(*(f"{path}/{name}" for name in taken))
        files = _write(added(rows, feed), log, feed, stream=None, batch_id=-1)
        done = [False]

        def change(now, files=files, taken=taken, done=done):
            done[0] = set(taken) <= now.files.keys()
            return {"add": files, "remove": taken} if done[0] else None

        log.commit(change)
        if done[0]:
            return


def train(spark, path, min_rows=training.MIN_ROWS):
    """The model of all events that the sums stand for, or None for fewer than ``min_rows`` pairs."""
    return training.train_on_hours(*(hours(read_sums(spark, path, feed), feed) for feed in MEASURES), min_rows)
