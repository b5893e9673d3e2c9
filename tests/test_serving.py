"""Upserts, replays, order of runs and reads of the serving table."""

import datetime
import glob
import os
import random
import threading

from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.operators import serving
from kerbside.operators.commits import Log

START = datetime.datetime(2024, 1, 1)


def rows(spark, *values):
    """Serving rows of (district, minute, pm25)."""
    return spark.createDataFrame(
        [
            (district, START + datetime.timedelta(minutes=minute), 40.0, 5, pm25, None, "NORMAL", None)
            for district, minute, pm25 in values
        ],
        schemas.SERVING,
    )


def current(spark, path):
    found = serving.current(spark, path).collect()
    assert sorted(found) == sorted(serving.latest(serving.read_log(spark, path)).select(*schemas.SERVING.names).collect())
    return {(row.district, row.window_end.minute): row.avg_pm25 for row in found}


def test_last_write_wins_and_replays_change_nothing(spark, folder):
    first = rows(spark, ("Centre", 1, 10.0), ("Centre", 2, 20.0), ("Nord", 1, 30.0))
    second = rows(spark, ("Centre", 2, 21.0), ("Nord", 2, 31.0))
    serving.upsert_batch(first, 0, folder)
    serving.upsert_batch(second, 1, folder)
    expected = {
        ("Centre", 1): 10.0,
        ("Centre", 2): 21.0,
        ("Nord", 1): 30.0,
        ("Nord", 2): 31.0,
    }
    assert current(spark, folder) == expected
    serving.upsert_batch(second, 1, folder)
    serving.upsert_batch(first, 0, folder)
    assert current(spark, folder) == expected
    assert serving.read_log(spark, folder).count() == 5
    assert serving.latest(serving.read_log(spark, f"{folder}/none")).count() == 0


def test_a_null_overwrites_too(spark, folder):
    serving.upsert_batch(rows(spark, ("Centre", 1, 10.0)), 0, folder)
    serving.upsert_batch(rows(spark, ("Centre", 1, None)), 1, folder)
    assert current(spark, folder) == {("Centre", 1): None}


def test_later_run_wins_over_higher_batch(spark, folder):
    serving.upsert_batch(rows(spark, ("Centre", 1, 10.0)), 12, folder, run_id=0)
    serving.upsert_batch(rows(spark, ("Centre", 1, 11.0)), 9, folder, run_id=1)
    assert current(spark, folder) == {("Centre", 1): 11.0}


def test_empty_batch_and_null_district_are_not_stored(spark, folder):
    serving.upsert_batch(rows(spark).limit(0), 0, folder)
    assert glob.glob(f"{folder}/*") == []
    serving.upsert_batch(rows(spark, (None, 1, 10.0), ("Centre", 1, 11.0)), 1, folder)
    assert current(spark, folder) == {("Centre", 1): 11.0}


def test_layout(spark, folder):
    batch = rows(spark, *[("Centre", minute, float(minute)) for minute in range(40)])
    serving.upsert_batch(batch, 3, folder, run_id=2, rows_per_file=10)
    files = glob.glob(f"{folder}/data/*/*.parquet")
    assert len(files) > 1
    for file in files:
        minutes = [row.window_end for row in spark.read.parquet(file).collect()]
        assert minutes == sorted(minutes, reverse=True)
    listed = Log(spark, folder).table().files
    assert len(listed) == len(files) and sum(f["rows"] for f in listed.values()) == 40
    assert len(current(spark, folder)) == 40


def test_district_series(spark, folder):
    serving.upsert_batch(
        rows(spark, ("Centre", 1, 10.0), ("Centre", 2, 20.0), ("Nord", 1, 30.0), ("007", 1, 7.0)),
        0,
        folder,
    )
    series = serving.district_series(spark, folder, "Centre")
    assert series.columns == ["window_end", "avg_pm25", "predicted_pm25"]
    assert [row.avg_pm25 for row in series.collect()] == [20.0, 10.0]
    assert serving.district_series(spark, folder, "007").count() == 1
    plan = series._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(district,Centre)" in plan[plan.index("PushedFilters") :]
    assert "ReadSchema: struct<district:string,window_end:timestamp,avg_pm25:double,predicted_pm25:double>" in plan
    assert serving.district_series(spark, f"{folder}/none", "Centre").count() == 0


def test_series_opens_only_files_of_its_keys(spark, folder):
    """After a fold into files of few rows, one district and day are in few of them."""
    minutes = [day * 1440 + i for day in range(4) for i in range(0, 60, 10)]
    names = ["Centre", "Est", "Nord", "Sud"]
    for batch_id, minute in enumerate(minutes[::6]):
        batch = [(name, minute + 10 * i, float(i)) for name in names for i in range(6)]
        serving.upsert_batch(rows(spark, *batch), batch_id, folder)
    serving.fold(spark, folder, rows_per_file=6)
    table = Log(spark, folder).table()
    for district, since, least in (("Est", "2024-01-04", 6), ("Nord", None, 24), ("Sud", "2024-01-03", 12)):
        series = serving.district_series(spark, folder, district, since)
        assert series.count() == least
        own = {n for n, f in table.files.items() if f["districts"][0] <= district <= f["districts"][1]}
        own = {n for n in own if since is None or f"{datetime.datetime.fromtimestamp(table.files[n]['times'][1] / 1e6, datetime.timezone.utc):%F}" >= since}
        assert {"/".join(name.rsplit("/", 3)[1:]) for name in series.inputFiles()} == {f"data/{n.split('/', 1)[1]}" for n in own}
        assert len(own) < len(table.files)


def test_order_of_the_whole_table(spark, folder):
    serving.upsert_batch(
        rows(spark, ("Nord", 1, 1.0), ("Centre", 1, 1.0), ("Centre", 2, 1.0)), 0, folder
    )
    found = serving.newest_first(serving.current(spark, folder)).collect()
    assert [(row.district, row.window_end.minute) for row in found] == [
        ("Centre", 2),
        ("Centre", 1),
        ("Nord", 1),
    ]


def test_files_from_before_a_column_was_added(spark, folder):
    serving.upsert_batch(rows(spark, ("Centre", 1, 10.0)), 0, folder)
    (name,) = Log(spark, folder).table().files
    spark.read.parquet(f"{folder}/{name}").drop("predicted_pm25", "alert_predicted").write.parquet(f"{folder}/narrow")
    for file in (name, "/.".join(name.rsplit("/", 1)) + ".crc"):
        os.remove(f"{folder}/{file}")
    os.rename(glob.glob(f"{folder}/narrow/*.parquet")[0], f"{folder}/{name}")
    newer = rows(spark, ("Nord", 1, 20.0)).withColumn("predicted_pm25", F.lit(33.0))
    serving.upsert_batch(newer, 1, folder)
    found = serving.current(spark, folder).collect()
    assert {row.district: row.predicted_pm25 for row in found} == {"Centre": None, "Nord": 33.0}


def kinds(spark, folder):
    files = Log(spark, folder).table().files.values()
    return {kind: sum(f["rows"] for f in files if f["kind"] == kind) for kind in (serving.BASE, serving.BATCH)}


def test_fold(spark, folder):
    for batch_id, value in enumerate((10.0, 11.0, 12.0)):
        serving.upsert_batch(rows(spark, ("Centre", 1, value), ("Nord", 2, 5.0)), batch_id, folder)
    serving.upsert_batch(rows(spark, ("Centre", 2 * 1440, 7.0)), 3, folder)
    serving.fold(spark, folder, "2024-01-02")
    assert kinds(spark, folder) == {"base": 2, "batch": 1}
    assert current(spark, folder) == {("Centre", 1): 12.0, ("Nord", 2): 5.0, ("Centre", 0): 7.0}
    # A late replay loses to the base, the next batch wins; folding again takes both in.
    serving.upsert_batch(rows(spark, ("Centre", 1, 10.0)), 0, folder)
    assert current(spark, folder)["Centre", 1] == 12.0
    serving.upsert_batch(rows(spark, ("Centre", 1, 13.0)), 4, folder)
    assert current(spark, folder)["Centre", 1] == 13.0
    serving.fold(spark, folder)
    serving.fold(spark, folder)
    assert current(spark, folder) == {("Centre", 1): 13.0, ("Nord", 2): 5.0, ("Centre", 0): 7.0}
    assert kinds(spark, folder) == {"base": 3, "batch": 0}
    series = serving.district_series(spark, folder, "Centre", "2024-01-02")
    assert [row.avg_pm25 for row in series.collect()] == [7.0]


def test_fold_of_a_batch_over_two_days(spark, folder):
    serving.upsert_batch(rows(spark, ("Centre", 1, 1.0), ("Centre", 1441, 2.0)), 0, folder)
    serving.upsert_batch(rows(spark, ("Centre", 1441, 3.0), ("Centre", 2, 4.0)), 1, folder)
    serving.fold(spark, folder, "2024-01-02")
    assert kinds(spark, folder) == {"base": 2, "batch": 2}
    assert serving.current(spark, folder).count() == 3
    serving.upsert_batch(rows(spark, ("Centre", 1441, 9.0)), 2, folder)
    serving.fold(spark, folder, "2024-01-03")
    assert {(r.window_end.day, r.avg_pm25) for r in serving.current(spark, folder).collect()} == {(1, 1.0), (1, 4.0), (2, 9.0)}


def test_keys_twice_in_a_batch(spark, folder):
    serving.upsert_batch(rows(spark, ("Centre", 1, 1.0), ("Centre", 1, 2.0), ("Nord", 1, 2.0)), 0, folder)
    assert current(spark, folder)[("Nord", 1)] == 2.0 and serving.current(spark, folder).count() == 2


def test_readers_keep_their_list(spark, folder):
    """A reader that began before a fold, a write and a clean-up within its hours sees what it began with."""
    for batch_id in range(3):
        serving.upsert_batch(rows(spark, ("Centre", 1, float(batch_id)), ("Nord", batch_id, 1.0)), batch_id, folder)
    version = Log(spark, folder).newest()
    began = serving.current(spark, folder)
    serving.fold(spark, folder)
    serving.upsert_batch(rows(spark, ("Centre", 1, 50.0)), 3, folder)
    serving.clean(spark, folder, hours=1)
    want = {("Centre", 1): 2.0, ("Nord", 0): 1.0, ("Nord", 1): 1.0, ("Nord", 2): 1.0}
    for frame in (began, serving.current(spark, folder, version=version)):
        assert {(r.district, r.window_end.minute): r.avg_pm25 for r in frame.collect()} == want
    assert current(spark, folder) == want | {("Centre", 1): 50.0}
    before = len(glob.glob(f"{folder}/data/*"))
    serving.clean(spark, folder, hours=0)
    assert before - len(glob.glob(f"{folder}/data/*")) == 3
    serving.clean(spark, folder, hours=0)
    assert current(spark, folder) == want | {("Centre", 1): 50.0}


def test_writers_folds_and_readers_at_once(spark, folder):
    failures = []

    def guarded(work):
        try:
            work()
        except Exception as error:  # reported by the assertion below
            failures.append(error)

    def write(run_id):
        for batch_id in range(6):
            serving.upsert_batch(rows(spark, ("Centre", batch_id, 10.0 * run_id + batch_id), (f"D{run_id}", batch_id, 1.0)), batch_id, folder, run_id)

    def fold():
        for _ in range(3):
            serving.fold(spark, folder)

    def read():
        for _ in range(6):
            found = serving.current(spark, folder).collect()
            assert len({(r.district, r.window_end) for r in found}) == len(found)

    threads = [threading.Thread(target=guarded, args=(work,)) for work in (lambda: write(0), lambda: write(1), fold, read)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert failures == []
    expected = {("Centre", i): 10.0 + i for i in range(6)} | {(f"D{r}", i): 1.0 for r in (0, 1) for i in range(6)}
    assert current(spark, folder) == expected
    serving.fold(spark, folder)
    assert current(spark, folder) == expected and kinds(spark, folder) == {"base": 18, "batch": 0}


def test_commits_have_no_gaps(spark, folder):
    """Many commits: the newest is found, older ones stay readable."""
    log = Log(spark, folder)
    assert log.newest() == -1 and log.table().files == {}
    for i in range(70):
        log.commit(lambda table, i=i: {"add": {f"data/{i}/x": {"rows": i}}, "remove": [f"data/{i - 2}/x"] if i > 1 else []})
        assert log.newest() == i
    for version in (0, 1, 31, 32, 33, 69):
        assert list(log.table(version).files) == [f"data/{i}/x" for i in range(max(0, version - 1), version + 1)]
    assert not log.store.publish(log._name(69), "{}")


def test_runs_belong_to_writers(spark, folder):
    assert [serving.run_of(spark, folder, w) for w in ("a", "b", "a", "c", "b")] == [0, 1, 0, 2, 1]
    assert serving.read_log(spark, folder).count() == 0


def test_odd_district_names(spark, folder):
    names = ["a/b", "x=1", "50%", "Über den Linden", "a:b"]
    serving.upsert_batch(rows(spark, *[(name, 1, 1.0) for name in names]), 0, folder)
    for name in names:
        assert serving.read_log(spark, folder, name).count() == 1


def test_external_store_gets_serving_rows(spark, folder):
    scored = rows(spark, ("Centre", 1, 10.0), (None, 1, 5.0)).withColumn("extra", F.lit(1))
    serving.append_to_store(scored, 0, "json", path=f"{folder}/store")
    stored = spark.read.json(f"{folder}/store")
    assert stored.count() == 1
    serving.append_to_store(scored.limit(0), 1, "json", path=f"{folder}/empty")
    assert glob.glob(f"{folder}/empty") == []
    assert set(stored.columns) <= set(schemas.SERVING.names)


def test_random_batches_against_brute_force(spark, folder):
    draw = random.Random(3)
    written, expected = {}, {}
    for run_id, batch_id in ((0, 0), (0, 1), (0, 2), (1, 0), (1, 1)):
        keys = [(district, minute) for district in ("Centre", "Nord") for minute in range(6)]
        values = [(*key, draw.random()) for key in draw.sample(keys, 5)]
        written[run_id, batch_id] = values
        expected.update({(district, minute): value for district, minute, value in values})
    order = [*written, *draw.sample(list(written), 3)]
    draw.shuffle(order)
    for run_id, batch_id in order:
        serving.upsert_batch(rows(spark, *written[run_id, batch_id]), batch_id, folder, run_id)
    assert current(spark, folder) == expected
