"""The serving table: the last written row per (district, window_end).

A batch becomes files of rows sorted by district and time, listed in the table's log with the
ranges of their keys; the highest (run, batch) per key counts. ``fold`` puts rows of days that
are over into a base with one row per key, as a new list. Files are never changed and readers
keep to the list they began with, so writing, folding and reading go on side by side.
"""

import logging
from datetime import datetime, timedelta, timezone
from uuid import uuid4

from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from kerbside import schemas
from kerbside.operators.commits import Log

log = logging.getLogger(__name__)

ROWS_PER_FILE = 1_000_000
WRITE_ORDER = ["run_id", "batch_id"]
BATCH, BASE = "batch", "base"
KEPT_HOURS = 24


def serving_rows(scored):
    """The stored columns. The key must be whole, so rows without a district stay out."""
    rows = scored.where(F.col("district").isNotNull())
    if "alert_predicted" not in rows.columns:
        rows = rows.withColumn("alert_predicted", F.lit(None).cast("string"))
    return rows.select(*schemas.SERVING.names)


RANGES = {
    "rows": "count(*)",
    "districts": "array(min(district), max(district))",
    "times": "array(unix_micros(min(window_end)), unix_micros(max(window_end)))",
}


def _write(rows, log_, count, rows_per_file, kind, order=(None, None)):
    """Write rows as sorted files of similar size; their entries for the log, which does not have them yet."""
    folder = f"data/{uuid4().hex}"
    by = ["district", F.col("window_end").desc()]
    files = 1 + count // rows_per_file
    # Cut by time within a district too, newest window first.
    placed = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, *by)
    placed.sortWithinPartitions(*by).write.parquet(f"{log_.store.path}/{folder}")
    names = [f"{folder}/{f}" for f in log_.store.files_in(folder) if f.endswith(".parquet")]
    written = rows.sparkSession.read.schema(schemas.SERVING_LOG).parquet(*(log_.store.full_name(n) for n in names))
    keys = F.lit(None) if kind == BASE else F.count_distinct(*schemas.SERVING_KEY)
    ranges = written.groupBy(F.col("_metadata.file_name").alias("name")).agg(keys.alias("keys"), *(F.expr(v).alias(k) for k, v in RANGES.items()))
    run_id, batch_id = order
    return {
        f"{folder}/{r.name}": {k: r[k] for k in RANGES}
        | {"kind": kind, "unique": r["keys"] in (None, r["rows"]), "run_id": run_id, "batch_id": batch_id}
        for r in ranges.collect()  # a row for each file
    }


def upsert_batch(rows, batch_id, path, run_id=0, rows_per_file=ROWS_PER_FILE):
    """Write one batch in place of what it wrote before; rows that the key keeps out are counted in the log.

    The batch is there with its commit: a crash before leaves files that no list has.
    """
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count, keyed = rows.agg(F.count(F.lit(1)), F.count("district")).first()
        log.info("batch %s: %s rows, %s left out without a district", batch_id, count, count - keyed)
        if keyed == 0:
            return
        placed = serving_rows(rows).withColumns({"run_id": F.lit(run_id).cast("long"), "batch_id": F.lit(batch_id).cast("long")})
        table_log = Log(rows.sparkSession, path)
        files = _write(placed, table_log, keyed, rows_per_file, BATCH, (run_id, batch_id))
    finally:
        rows.unpersist()

    def change(table):
        own = [n for n, f in table.files.items() if f["kind"] == BATCH and (f["run_id"], f["batch_id"]) == (run_id, batch_id)]
        return {"add": files, "remove": own}

    table_log.commit(change)


def append_to_store(rows, batch_id, fmt, **options):
    """Append to an external keyed store, whose primary key makes this an upsert."""
    rows = serving_rows(rows)
    if not rows.isEmpty():
        rows.write.format(fmt).options(**options).mode("append").save()


def run_of(spark, path, writer):
    """The run of a writer, named by its checkpoint's id: its own for good, above all earlier ones.

    A new checkpoint counts its batches from zero again; in a run of its own these neither
    replace nor lose to those of another.
    """

    def change(table):
        if writer in table.writers:
            return None
        return {"writers": {writer: 1 + max(table.writers.values(), default=-1)}}

    return Log(spark, path).commit(change).writers[writer]


def _micros(day):
    """The first moment of a UTC day (yyyy-MM-dd or a date)."""
    return int(datetime.fromisoformat(str(day)).replace(tzinfo=timezone.utc).timestamp()) * 1_000_000


def files_of(table, district=None, since=None):
    """Names of the files that may have rows of the district, from the day ``since`` on."""
    least = None if since is None else _micros(since)
    return [
        name
        for name, f in table.files.items()
        if (district is None or f["districts"][0] <= district <= f["districts"][1])
        and (least is None or f["times"][1] >= least)
    ]


def _rows(spark, path, names):
    names = [f"{path}/{name}" for name in names]
    if not names:
        return spark.createDataFrame([], schemas.SERVING_LOG)
    return spark.read.schema(schemas.SERVING_LOG).parquet(*names)


def read_log(spark, path, district=None, since=None, version=None):
    """All rows as written, of the newest commit or an earlier one; none where nothing was.

    Columns added later are null in older files. Opens only files whose keys may match.
    """
    table = Log(spark, path).table(version)
    return _wanted(_rows(spark, path, files_of(table, district, since)), district, since)


def _wanted(rows, district, since):
    if district is not None:
        rows = rows.where(F.col("district") == district)
    if since is not None:
        rows = rows.where(F.col("window_end") >= F.timestamp_micros(F.lit(_micros(since))))
    return rows


def latest(batches):
    """Last write wins, among rows as written."""
    values = [c for c in batches.columns if c not in (*schemas.SERVING_KEY, *WRITE_ORDER)]
    return (
        batches.groupBy(schemas.SERVING_KEY)
        .agg(F.max_by(F.struct(*values), F.struct(*WRITE_ORDER)).alias("row"))
        .select(*schemas.SERVING_KEY, "row.*")
    )


def _sharing(table, names):
    """Pairs of files whose ranges of keys meet; one pass in order of time. What was written at once shares no key."""
    open_files = []
    for name in sorted(names, key=lambda n: table.files[n]["times"][0]):
        f = table.files[name]
        open_files = [n for n in open_files if table.files[n]["times"][1] >= f["times"][0]]
        for other in open_files:
            low, high = table.files[other]["districts"]
            if low <= f["districts"][1] and f["districts"][0] <= high and _folder(name) != _folder(other):
                yield name, other
        open_files.append(name)


def _folder(name):
    return name.rsplit("/", 1)[0]


def _settled(table, names):
    """Those of the files whose rows are the last of their keys for certain: each once, and in no other file's range."""
    shared = {name for pair in _sharing(table, names) for name in pair}
    return {name for name in names if name not in shared and table.files[name]["unique"]}


def current(spark, path, district=None, since=None, columns=None, version=None):
    """The table's rows: one per key, the last written. Files that no other overlaps are passed as they are."""
    table = Log(spark, path).table(version)
    columns = columns or schemas.SERVING.names
    names = files_of(table, district, since)
    settled = _settled(table, names)
    parts = []
    for keep in (True, False):
        own = [n for n in names if (n in settled) == keep]
        if own or (keep and not names):
            rows = _wanted(_rows(spark, path, own), district, since)
            needed = dict.fromkeys([*schemas.SERVING_KEY, *columns, *WRITE_ORDER])
            parts.append((rows if keep else latest(rows.select(*needed))).select(*columns))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def district_series(spark, path, district, since=None):
    """Observed and predicted PM2.5 of one district, newest first, from the day ``since`` on."""
    columns = ["window_end", "avg_pm25", "predicted_pm25"]
    return current(spark, path, district, since, columns).orderBy(F.col("window_end").desc())


def newest_first(rows):
    return rows.orderBy("district", F.col("window_end").desc())


def fold(spark, path, before=None, rows_per_file=ROWS_PER_FILE):
    """Gather the days before ``before`` (all without it) into the base, one row per key.

    The job that writes the table goes on meanwhile and keeps its checkpoint; what it writes has
    a higher batch and wins. Readers go on with the list they have: files that leave the list
    stay until ``clean``. Only files of such days, and base files that share keys with them, are
    written again. A fold that another one, or a batch written again, has overtaken starts anew.
    """
    table_log = Log(spark, path)
    while True:
        table = table_log.table()
        least = None if before is None else _micros(before)
        recent = [n for n, f in table.files.items() if f["kind"] == BATCH and (least is None or f["times"][0] < least)]
        if not recent:
            return
        base = [n for n, f in table.files.items() if f["kind"] == BASE]
        new = set(recent)
        old = sorted({n for pair in _sharing(table, base + recent) if new.intersection(pair) for n in pair if n not in new})
        rows = _rows(spark, path, recent + old)
        over = F.lit(True) if before is None else F.col("window_end") < F.timestamp_micros(F.lit(least))
        count = sum(table.files[n]["rows"] for n in recent + old)
        values = [c for c in rows.columns if c not in schemas.SERVING_KEY]
        won = rows.where(over).groupBy(schemas.SERVING_KEY).agg(F.max_by(F.struct(*values), F.struct(*WRITE_ORDER)).alias("row"))
        files = _write(won.select(*schemas.SERVING_KEY, "row.*").select(*rows.columns), table_log, count, rows_per_file, BASE)
        if least is not None and any(table.files[n]["times"][1] >= least for n in recent):
            files |= _write(rows.where(~over), table_log, count, rows_per_file, BATCH)
        done = [False]

        def change(newest, files=files, gathered=recent + old, done=done):
            done[0] = set(gathered) <= newest.files.keys()
            return {"add": files, "remove": gathered} if done[0] else None

        table_log.commit(change)
        if done[0]:
            return


def clean(spark, path, hours=KEPT_HOURS):
    """Remove files that left the list more than so many hours ago, for readers that began before to end."""
    table_log = Log(spark, path)
    moment = datetime.now(timezone.utc) - timedelta(hours=hours)
    gone, cleaned = table_log.removed_before(moment.timestamp())
    listed = {_folder(name) for name in table_log.table().files}
    for folder in {_folder(name) for name in gone} - listed:  # a folder for each write
        table_log.store.remove(folder)
    table_log.commit(lambda table: {"cleaned": cleaned} if cleaned > table.cleaned else None)
