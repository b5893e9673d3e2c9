"""Packed and live history as one, and sums kept up to date, against the events themselves."""

import random
from decimal import Decimal

import pytest

from helpers import pollution, send, traffic
from kerbside import schemas
from kerbside.operators import moments, packing, training
from kerbside.operators.commits import Log
from kerbside.sources.datasets import read_silver
from kerbside.sources.topics import read_message_files
from kerbside.streaming.layers import start_moments, start_silver
from kerbside.streaming.triggers import ONCE

SENT = {"traffic": traffic, "pollution": pollution}


class Silver:
    """Cleaned feeds as a stream writes them, run by run."""

    def __init__(self, spark, folder, by_day=False):
        self.spark, self.folder, self.by_day = spark, folder, by_day

    def path(self, feed):
        return f"{self.folder}/silver/{feed}"

    def run(self, feed, rows):
        send(self.spark, rows, f"{self.folder}/sent/{feed}")
        messages = read_message_files(self.spark, f"{self.folder}/sent/{feed}")
        start_silver(messages, schemas.PAYLOADS[feed], self.path(feed), f"{self.folder}/progress/{feed}", ONCE, by_day=self.by_day).awaitTermination()

    def pack(self, feed="traffic", **options):
        return packing.pack(self.spark, self.path(feed), f"{self.folder}/packed/{feed}", feed, **options)

    def history(self, feed="traffic"):
        return packing.read_history(self.spark, self.path(feed), f"{self.folder}/packed/{feed}", feed)


def same(a, b):
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("by_day", [False, True])
def test_packed_and_live(spark, folder, by_day):
    silver = Silver(spark, folder, by_day)
    assert silver.pack() == 0 and silver.history().count() == 0
    silver.run("traffic", [traffic("00:00:10", speed=s, district=d) for s in range(9) for d in ("Centre", "a/b c", "50%")])
    silver.run("traffic", [traffic("00:05:00", district="Nord"), traffic("bad"), traffic("00:01:00")] * 2)
    stored = read_silver(spark, silver.path("traffic"), "traffic").select(*schemas.SILVER["traffic"].names)
    assert same(silver.history(), stored)
    assert silver.pack(rows_per_file=5) > 0
    assert same(silver.history(), stored)
    # Nothing new: nothing is packed. New files are read as they are, then packed as well.
    assert silver.pack() == 0
    silver.run("traffic", [traffic("00:07:00", district="Centre")] * 3)
    assert silver.history().count() == 36
    opened = {name.split("/packed/")[0] for name in silver.history().inputFiles() if "/silver/" in name}
    assert len(opened) == 1
    assert silver.pack() == 1
    assert same(silver.history(), read_silver(spark, silver.path("traffic"), "traffic").select(*schemas.SILVER["traffic"].names))
    assert not any("/silver/" in name for name in silver.history().inputFiles())
    days = [name for name in silver.history().inputFiles() if "/event_date=2024-01-01/" in name]
    assert days
    plan = silver.history().where("district = 'Nord'")._jdf.queryExecution().executedPlan().toString()
    assert "district" in plan[plan.index("PartitionFilters") :]


def test_only_files_of_earlier_days(spark, folder):
    silver = Silver(spark, folder)
    silver.run("traffic", [traffic("00:00:10"), traffic("bad")])
    silver.run("traffic", [traffic("23:59:59")])
    assert silver.pack(before="2024-01-01") == 0
    assert silver.pack(before="2024-01-02") == 2
    assert silver.history().count() == 3


def test_an_overtaken_run_starts_anew(spark, folder, monkeypatch):
    silver = Silver(spark, folder)
    silver.run("traffic", [traffic("00:00:10")] * 4)
    whole = Log.commit
    calls = []

    def late(log, change):
        if not calls:
            calls.append(1)
            silver.pack()  # another run packs the same files first
        return whole(log, change)

    monkeypatch.setattr(Log, "commit", late)
    assert silver.pack() == 0
    assert silver.history().count() == 4


def test_sums_follow_the_stream(spark, folder):
    rng = random.Random(6)
    silver = Silver(spark, folder)
    path = f"{folder}/sums"
    assert moments.train(spark, path) is None
    for _ in range(3):
        for feed in SENT:
            value = {"traffic": lambda: {"speed": rng.randrange(130)}, "pollution": lambda: {"pm25": rng.randrange(100)}}[feed]
            silver.run(feed, [SENT[feed](f"0{rng.randrange(4)}:{rng.randrange(10, 60)}:00", district=rng.choice(["Centre", "Nord"]), **value()) for _ in range(25)])
            start_moments(spark, silver.path(feed), feed, path, f"{folder}/progress_{feed}", ONCE).awaitTermination()
    sides = [read_silver(spark, silver.path(feed), feed) for feed in SENT]
    want = {(r.district, r.hour): r for r in training.paired_hours(*sides).collect()}

    def check():
        found = training.joined_hours(*(moments.hours(moments.read_sums(spark, path, feed), feed) for feed in SENT)).collect()
        assert {(r.district, r.hour) for r in found} == want.keys()
        for r in found:
            expected = want[r.district, r.hour].asDict()
            assert {k: v for k, v in r.asDict().items() if k not in ("district", "hour")} == pytest.approx({k: v for k, v in expected.items() if k not in ("district", "hour")}, abs=1e-9)

    check()
    # A batch written again replaces itself; merged files stand for all but the newest batch of the stream.
    entries = Log(spark, path).table().files
    name, entry = next((n, f) for n, f in entries.items() if f["feed"] == "traffic" and f["batch_id"] == 2)
    repeated = training.complete_hours(sides[0], "speed_kmh", "vehicle_count").limit(0)
    moments.add_batch(repeated.select(*sides[0].columns), 2, path, "traffic", entry["stream"])
    moments.add_batch(sides[0].limit(0), 3, path, "traffic", "another")
    assert name not in Log(spark, path).table().files
    moments.merge(spark, path, "pollution")
    assert len([f for f in Log(spark, path).table().files.values() if f["feed"] == "pollution"]) == 2
    moments.merge(spark, path, "pollution")
    found = moments.hours(moments.read_sums(spark, path, "pollution"), "pollution").collect()
    assert {(r.district, r.hour): r.n_pollution for r in found}.items() >= {k: r.n_pollution for k, r in want.items()}.items()


def test_sums_are_exact(spark):
    """Variances from sums that no double holds."""
    rows = spark.createDataFrame([("Centre", 10**9, Decimal(10**17 + 7), Decimal(10**25))], "district string, n long, pm25_sum decimal(38,0), pm25_pm25 decimal(38,0)").selectExpr("district", "timestamp '2024-01-01' AS hour", "n", "pm25_sum", "pm25_pm25")
    row = moments.hours(rows, "pollution").collect()[0]
    assert row.pm25_var == pytest.approx((10**9 * 10**25 - (10**17 + 7) ** 2) / 10**18)
