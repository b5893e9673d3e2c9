"""Cleaned history as large packed files and the live files that came since, as one dataset.

A stream writes many small files. ``pack`` rewrites those it has committed and that no earlier
run has packed into a generation of sorted files by district and day, and commits to a log which
files it wrote and which live ones stand in them. A reader takes the packed files and the live
ones that are not in the log, so each event is there once, also while a pack runs. Live files
are never changed or removed, as the sink's own log lists them.
"""

from urllib.parse import unquote, urlsplit
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import layers
from kerbside.operators.commits import Log, Store

PACKED, LIVE = "packed", "live"
ROWS = "rows"


def _relative(spark, path, names):
    """Names of files below ``path``, as the file system has them."""
    root = urlsplit(Store(spark, path).full_name("")).path.rstrip("/") + "/"
    return [unquote(urlsplit(name).path).removeprefix(unquote(root)) for name in names]


def _committed(spark, path, feed):
    """The files of the live dataset that its sink has committed."""
    try:
        names = spark.read.schema(schemas.SILVER[feed]).parquet(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return _relative(spark, path, names)


def _read(spark, base, names, feed):
    schema = schemas.SILVER[feed]
    paths = [f"{base}/{name}" for name in names]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def _of_kind(table, kind):
    return [name for name, f in table.files.items() if f["kind"] == kind]


def read_history(spark, path, packed, feed):
    """All events of a feed, from the live dataset at ``path`` and the packed one, each once."""
    live = _committed(spark, path, feed)
    table = Log(spark, packed).table()
    done = set(_of_kind(table, LIVE))
    fresh = _read(spark, path, [name for name in live if name not in done], feed)
    old = _of_kind(table, PACKED)
    return fresh.union(_read(spark, f"{packed}/{ROWS}", old, feed)) if old else fresh


def _over(spark, path, names, feed, before):
    """Those of the files that have no event from the day ``before`` on."""
    rows = _read(spark, path, names, feed).select(F.col("_metadata.file_path").alias("name"), "event_time")
    late = rows.where(F.col("event_time") >= F.lit(before).cast("timestamp")).select("name").distinct()
    late = {r.name for r in late.collect()}  # no more than there are live files
    return [name for name in names if name not in set(_relative(spark, path, late))]


def pack(spark, path, packed, feed, rows_per_file=5_000_000, before=None):
    """Pack what the stream has committed since the last time; ``before``: only files of earlier days.

    Returns the number of live files taken in. A run that another one has overtaken starts anew.
    """
    log = Log(spark, packed)
    while True:
        table = log.table()
        done = set(_of_kind(table, LIVE))
        fresh = [name for name in _committed(spark, path, feed) if name not in done]
        if fresh and before is not None:
            fresh = _over(spark, path, fresh, feed, before)
        if not fresh:
            return 0
        generation = f"generation={uuid4().hex}"
        rows = layers.with_day(_read(spark, path, fresh, feed))
        target = f"{packed}/{ROWS}/{generation}"
        layers.pack(rows, rows_per_file).write.partitionBy("district", "event_date").parquet(target)
        wrote = spark.read.schema(schemas.SILVER[feed]).parquet(target).inputFiles()
        files = {name: {"kind": PACKED} for name in _relative(spark, f"{packed}/{ROWS}", wrote)}
        files |= {name: {"kind": LIVE} for name in fresh}
        done = [False]

        def change(newest, files=files, fresh=fresh, done=done):
            done[0] = newest.files.keys().isdisjoint(fresh)
            return {"add": files} if done[0] else None

        log.commit(change)
        if done[0]:
            return len(fresh)
