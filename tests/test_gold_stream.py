"""The gold stream: closing windows, late rows, stalls, restarts and scoring."""

import random

import pytest

from helpers import messages, pollution, send, traffic
from kerbside import schemas
from kerbside.operators import corrections, scoring, serving
from kerbside.operators.layers import to_silver
from kerbside.sources.topics import read_message_files
from kerbside.session import shuffle_partitions
from kerbside.streaming.carry import CARRIED, carry, windows_from
from kerbside.streaming.gold import start_gold, start_windows, store_sink, table_sink, windows
from kerbside.streaming.triggers import ONCE
from test_scoring import train


class Feeds:
    """Two feed folders and a gold query over them, run to its end on every ``run``."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        self.model = None
        self.sink = table_sink(f"{folder}/serving")
        for feed in ("traffic", "pollution"):
            # A feed folder must be there before its stream.
            send(spark, [], f"{folder}/{feed}")

    def run(self, traffic_rows, pollution_rows=()):
        for feed, rows in (("traffic", traffic_rows), ("pollution", pollution_rows)):
            if rows:
                send(self.spark, rows, f"{self.folder}/{feed}")
        rows = windows(
            *[
                read_message_files(self.spark, f"{self.folder}/{feed}")
                for feed in ("traffic", "pollution")
            ],
            **self.options,
        )
        query = start_gold(rows, self.sink, f"{self.folder}/progress", self.model, ONCE)
        query.awaitTermination()
        return query

    def served(self):
        found = serving.current(self.spark, f"{self.folder}/serving").collect()
        return {(row.district, f"{row.window_end:%H:%M}"): row for row in found}


def dropped(query):
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def test_window_comes_out_once_closed(spark, folder):
    feeds = Feeds(spark, folder)
    feeds.run(
        [traffic("00:00:10", speed=40), traffic("00:01:59")], [pollution("00:00:20", pm25=90)]
    )
    assert feeds.served() == {}
    feeds.run([traffic("00:00:50", speed=60), traffic("00:02:00")])
    rows = feeds.served()
    assert list(rows) == [("Centre", "00:01")]
    row = rows["Centre", "00:01"]
    assert (row.avg_speed, row.avg_pm25, row.alert_level) == (50.0, 90.0, "CRITIQUE")


def test_state_survives_a_restart_and_late_rows_are_dropped(spark, folder):
    feeds = Feeds(spark, folder)
    feeds.run([traffic("00:00:10"), traffic("00:02:10")])
    assert list(feeds.served()) == [("Centre", "00:01")]
    query = feeds.run([traffic("00:00:15", speed=99), traffic("00:01:30"), traffic("00:04:10")])
    assert dropped(query) == 1
    rows = feeds.served()
    assert sorted(end for _, end in rows) == ["00:01", "00:02", "00:03"]
    assert rows["Centre", "00:01"].avg_speed == 50.0


@pytest.mark.parametrize("per_feed", [False, True])
def test_stalled_feed(spark, folder, per_feed):
    """One merged watermark drops what a stalled feed brings late, one per feed waits for it."""
    feeds = Feeds(spark, folder, per_feed=per_feed)
    feeds.run([traffic("00:00:10"), traffic("00:10:30")], [pollution("00:00:05")])
    # After a restart each feed's own watermark is known again from its first event on.
    query = feeds.run(
        [traffic("00:10:40")], [pollution("00:00:40", pm25=90), pollution("00:09:00")]
    )
    assert dropped(query) == (0 if per_feed else 1)
    row = feeds.served()["Centre", "00:01"]
    assert row.avg_pm25 == (60.0 if per_feed else 30.0)


def test_windows_go_on_without_a_silent_feed(spark, folder):
    """A feed three minutes behind no longer holds the output; what it still sends in time counts."""
    feeds = Feeds(spark, folder, per_feed=True, idle="3 minutes", metrics="gold")
    feeds.run([traffic("00:00:10"), traffic(None), traffic("00:06:30")], [pollution("00:00:05")])
    # The newest traffic less three minutes and the delay: 00:02:30.
    assert set(feeds.served()) == {("Centre", "00:01")}
    late = [pollution("00:00:50", pm25=90), pollution("00:02:40", pm25=70), pollution(None)]
    query = feeds.run([traffic("00:06:40")], late)
    assert dropped(query) == 1
    # Also after a restart in which that feed sends nothing at all.
    feeds.run([traffic("00:20:00")])
    rows = feeds.served()
    assert sorted(end for _, end in rows) == ["00:01", "00:03", "00:07"]
    assert rows["Centre", "00:03"].avg_pm25 == 70.0 and rows["Centre", "00:01"].avg_pm25 == 30.0
    assert rows["Centre", "00:07"].avg_pm25 is None
    counts = [p.observedMetrics["gold_pollution"] for p in query.recentProgress if p.observedMetrics.get("gold_pollution")]
    assert sum(c.messages for c in counts) == 3 and sum(c.untimed for c in counts) == 1


def test_open_windows_carried_to_another_checkpoint(spark, folder):
    old = Feeds(spark, folder)
    first = [traffic("00:00:10"), traffic("00:02:10", speed=40), traffic("00:02:59", "Nord", speed=None), traffic("00:02:30", None)]
    old.run(first, [pollution("00:02:20", pm25=10)])
    assert set(old.served()) == {("Centre", "00:01")}
    positions = carry(spark, f"{folder}/progress", f"{folder}/open")
    assert len(positions) == 2

    new = f"{folder}/new"
    sent = {
        "traffic": [traffic("00:00:50", speed=1), traffic("00:02:40", speed=60), traffic("00:03:30")],
        "pollution": [pollution("00:02:41", pm25=90)],
    }

    def run(number, rows_by_feed):
        for feed, rows in rows_by_feed.items():
            send(spark, rows, f"{new}/{feed}")
        rows = windows_from(f"{folder}/open", *[read_message_files(spark, f"{new}/{feed}") for feed in sent])
        with shuffle_partitions(spark, 3):
            start_gold(rows, old.sink, f"{new}/progress", None, ONCE).awaitTermination()
        return old.served()

    rows = run(1, sent)
    # The late event for a window that is out is dropped, as the old stream would have.
    assert rows["Centre", "00:01"].avg_speed == 50.0
    assert set(rows) == {("Centre", "00:01")}
    rows = run(2, {"traffic": [traffic("00:09:00")], "pollution": []})
    assert set(rows) == {("Centre", "00:01"), ("Centre", "00:03"), ("Nord", "00:03"), ("Centre", "00:04")}
    assert (rows["Centre", "00:03"].avg_speed, rows["Centre", "00:03"].avg_pm25) == (50.0, 50.0)
    assert rows["Nord", "00:03"].avg_speed is None and rows["Nord", "00:03"].max_density == 10

    # Once more, from a checkpoint of this kind.
    carry(spark, f"{new}/progress", f"{folder}/again")
    left = spark.read.schema(CARRIED).parquet(f"{folder}/again").collect()
    assert [(row.district, row.speed_sum, row.speed_count) for row in left if row.own_time] == [("Centre", 50, 1)]


def test_bad_messages_are_counted_and_do_not_stop_the_stream(spark, folder):
    feeds = Feeds(spark, folder, metrics="gold")
    bad = ["not json", None, {**traffic(), "timestamp": "bad"}, traffic(time=None)]
    query = feeds.run([*bad, traffic("00:00:10"), traffic(district=None), traffic("00:05:00")])
    counts = query.recentProgress[0].observedMetrics["gold_traffic"]
    assert (counts.messages, counts.rejected, counts.untimed) == (7, 2, 4)
    # A null district is a KPI group, but no serving key.
    assert list(feeds.served()) == [("Centre", "00:01")]


def test_scoring_in_the_stream(spark, folder):
    """Windows are stored before there is a model, and scored from the first save on."""
    feeds = Feeds(spark, folder)
    feeds.model = f"{folder}/model"
    feeds.run([traffic("00:00:10"), traffic("00:02:10")], [pollution("00:00:20", district="Nord")])
    rows = feeds.served()
    assert len(rows) == 2 and {row.predicted_pm25 for row in rows.values()} == {None}
    model = train(spark)
    scoring.save(model, feeds.model)
    feeds.run(
        [traffic("00:02:20", speed=44, count=6), traffic("00:05:00")],
        [pollution("00:02:20", district="Nord")],
    )
    rows = feeds.served()
    line = model.stages[-1]
    # The speed is a mean with the event at 00:02:10.
    expected = line.intercept + line.coefficients.dot([47.0, 10])
    assert rows["Centre", "00:03"].predicted_pm25 == pytest.approx(expected)
    # No traffic in a district costs its prediction, not its row nor the batch.
    assert rows["Nord", "00:03"].predicted_pm25 is None
    assert rows["Nord", "00:03"].avg_pm25 == 30.0
    assert rows["Centre", "00:01"].predicted_pm25 is None


def test_external_sink(spark, folder):
    feeds = Feeds(spark, folder)
    feeds.sink = store_sink("json", path=f"{folder}/store")
    feeds.run([traffic("00:00:10"), traffic("00:05:00")])
    assert [row.district for row in spark.read.json(f"{folder}/store").collect()] == ["Centre"]


def test_sink_errors_are_raised(spark, folder):
    feeds = Feeds(spark, folder)
    feeds.sink = store_sink("no_such_format")
    with pytest.raises(Exception, match="no_such_format"):
        feeds.run([traffic("00:00:10"), traffic("00:05:00")])


def test_state_store_of_the_stream(spark, folder):
    send(spark, [traffic("00:00:10"), traffic("00:05:00")], f"{folder}/traffic")
    send(spark, [pollution("00:00:10")], f"{folder}/pollution")
    rows = windows(*[read_message_files(spark, f"{folder}/{f}") for f in ("traffic", "pollution")])
    query = start_windows(rows, f"{folder}/out", f"{folder}/progress", ONCE)
    query.awaitTermination()
    metrics = query.recentProgress[0]["stateOperators"][0]["customMetrics"]
    assert any(name.startswith("rocksdb") for name in metrics)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_arrivals_against_brute_force(spark, folder, seed):
    """Three runs of out-of-order events: what is late, what comes out and with which values."""
    draw = random.Random(seed)
    feeds = Feeds(spark, folder)
    newest, watermark, open_windows, expected, late = 0, 0, {}, {}, 0
    for start in (0, 180, 420):
        seconds = [start + draw.randrange(400) for _ in range(25)]
        speeds = [draw.randrange(130) for _ in seconds]
        districts = [draw.choice(["Centre", "Nord"]) for _ in seconds]
        query = feeds.run(
            [
                traffic(f"00:{second // 60:02}:{second % 60:02}", district, speed)
                for second, district, speed in zip(seconds, districts, speeds)
            ]
        )
        late_keys = set()
        for second, district, speed in zip(seconds, districts, speeds):
            end = (second // 60 + 1) * 60
            if end <= watermark:
                late_keys.add((district, end))
            else:
                open_windows.setdefault((district, end), []).append(speed)
        newest = max(newest, *seconds)
        watermark = max(watermark, newest - 60)
        for district, end in [key for key in open_windows if key[1] <= watermark]:
            values = open_windows.pop((district, end))
            expected[district, f"00:{end // 60:02}"] = sum(values) / len(values)
        late += len(late_keys)
        assert (dropped(query) > 0) == bool(late_keys)
    assert late > 0
    assert {key: row.avg_speed for key, row in feeds.served().items()} == expected


def test_batch_written_before_a_crash_is_replayed_in_place(spark, folder):
    feeds = Feeds(spark, folder)
    table = feeds.sink

    def write_then_crash(rows, batch_id, stream_id):
        table(rows, batch_id, stream_id)
        if rows.count():
            raise RuntimeError("lost after the write")

    feeds.sink = write_then_crash
    with pytest.raises(Exception, match="lost after the write"):
        feeds.run([traffic("00:00:10", speed=40), traffic("00:01:10"), traffic("00:05:00")])
    before = feeds.served()
    assert len(before) == 2
    feeds.sink = table
    feeds.run([traffic("00:05:10")])
    assert feeds.served() == before
    assert serving.read_log(spark, f"{folder}/serving").count() == 2


def test_late_events_are_corrected_from_history(spark, folder):
    """A late event of a window served, one of a district without a window, one of a window still open."""
    feeds = Feeds(spark, folder)
    sent = [[traffic("00:00:10", speed=40), pollution("00:00:20", pm25=10), traffic("00:05:00")], [traffic("00:00:30", speed=60), pollution("00:00:40", district="Nord", pm25=90), traffic("00:05:30"), traffic("00:01:00", district=None)]]
    for rows in sent:
        feeds.run([r for r in rows if "speed_kmh" in r], [r for r in rows if "pm25" in r])
    assert {k: r.avg_speed for k, r in feeds.served().items()} == {("Centre", "00:01"): 40.0}
    sides = [to_silver(messages(spark, [r for rows in sent for r in rows if key in r]), schemas.PAYLOADS[feed]) for feed, key in (("traffic", "speed_kmh"), ("pollution", "pm25"))]
    assert corrections.correct(spark, *sides, f"{folder}/serving", since="2024-01-02") == 0
    assert corrections.correct(spark, *sides, f"{folder}/serving", since="2024-01-01") == 2
    rows = feeds.served()
    assert {k: (r.avg_speed, r.avg_pm25, r.alert_level) for k, r in rows.items()} == {("Centre", "00:01"): (50.0, 10.0, "NORMAL"), ("Nord", "00:01"): (None, 90.0, "CRITIQUE")}
    assert corrections.correct(spark, *sides, f"{folder}/serving") == 0
    # The stream goes on, and what it repeats does not undo the correction.
    feeds.run([traffic("00:08:00")])
    assert feeds.served()["Centre", "00:01"].avg_speed == 50.0 and ("Centre", "00:06") in feeds.served()
    assert corrections.correct(spark, *[s.limit(0) for s in sides], f"{folder}/none") == 0


def test_a_model_saved_between_two_micro_batches(spark, folder):
    """One query: the windows of a batch have the model that was there when it began."""
    for minute in range(0, 40, 10):
        send(spark, [traffic(f"00:{minute:02}:10", speed=10 + minute)], f"{folder}/traffic")
    send(spark, [pollution("00:00:20")], f"{folder}/pollution")
    seen = []
    table = table_sink(f"{folder}/serving")

    def sink(rows, batch_id, stream_id):
        table(rows, batch_id, stream_id)
        seen.append(batch_id)
        if len(seen) == 1:
            scoring.save(train(spark), f"{folder}/model")

    kpi = windows(*[read_message_files(spark, f"{folder}/{feed}", maxFilesPerTrigger=1) for feed in ("traffic", "pollution")])
    query = start_gold(kpi, sink, f"{folder}/progress", f"{folder}/model", ONCE)
    query.awaitTermination()
    assert len(seen) >= 2 and query.exception() is None
    found = sorted(serving.current(spark, f"{folder}/serving").collect(), key=lambda r: r.window_end)
    assert found[0].predicted_pm25 is None and found[-1].predicted_pm25 is not None
