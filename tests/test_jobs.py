"""The command line jobs, chained from raw messages to the dashboard series."""

import pytest

from helpers import pollution, send, traffic
from kerbside import jobs, session
from kerbside.operators import serving
from kerbside.operators.packing import read_history
from kerbside.sources.datasets import read_bronze, read_silver


def clock(minute):
    return f"{minute // 60:02}:{minute % 60:02}:05"


@pytest.fixture(scope="module")
def city(spark, tmp_path_factory):
    """Every job run once over three hours of two districts; the folder they worked in."""
    folder = str(tmp_path_factory.mktemp("city"))
    minutes = range(0, 180, 5)
    send(
        spark,
        ["junk"]
        + [traffic(clock(m), d, 30 + m % 50, m % 45) for m in minutes for d in ("Centre", "Nord")],
        f"{folder}/traffic-raw",
    )
    send(
        spark,
        [pollution(clock(m), d, (m * 7) % 100) for m in minutes for d in ("Centre", "Nord")],
        f"{folder}/pollution-raw",
    )
    source = (
        f"--source parquet --traffic {folder}/traffic-raw --pollution {folder}/pollution-raw --once"
    )
    lines = [
        f"bronze {source} --output {folder}/bronze --checkpoint {folder}/ck/bronze",
        f"silver {source} --output {folder}/silver --checkpoint {folder}/ck/silver",
        f"train --silver {folder}/silver --model {folder}/model",
        f"gold {source} --serving {folder}/serving --checkpoint {folder}/ck/gold "
        f"--model {folder}/model --width 10minutes --source-option pathGlobFilter=*.parquet",
    ]
    for line in lines:
        argv = [arg.replace("10minutes", "10 minutes") for arg in line.split()]
        assert jobs.main(argv, spark) is not None
    return folder


def test_bronze(spark, city):
    assert read_bronze(spark, f"{city}/bronze/traffic").count() == 73
    assert read_bronze(spark, f"{city}/bronze/pollution").count() == 72


def test_silver_and_rejects(spark, city):
    assert read_silver(spark, f"{city}/silver/traffic", "traffic").count() == 72
    # Nothing is lost without any option: 73 messages came in.
    assert [row.json for row in spark.read.json(f"{city}/silver_rejects/traffic").collect()] == ["junk"]


def test_gold(spark, city):
    rows = serving.current(spark, f"{city}/serving")
    # 18 windows of ten minutes each; the last is still open.
    assert rows.count() == 34
    assert rows.where("predicted_pm25 IS NULL").count() == 0


def test_gold_from_carried_windows(spark, city, capsys):
    jobs.main(f"carry --checkpoint {city}/ck/gold --output {city}/open".split(), spark)
    assert capsys.readouterr().out.count("logOffset") == 2
    source = f"--source parquet --traffic {city}/traffic-new --pollution {city}/pollution-new --once"
    send(spark, [traffic("03:30:00")], f"{city}/traffic-new")
    send(spark, [pollution("02:55:30", "Nord", 10)], f"{city}/pollution-new")
    line = f"gold {source} --serving {city}/serving-new --checkpoint {city}/ck/new --carried {city}/open --width 10_minutes"
    jobs.main([arg.replace("_", " ") for arg in line.split()], spark)
    rows = {(row.district, f"{row.window_end:%H:%M}"): row for row in serving.current(spark, f"{city}/serving-new").collect()}
    # Both open ten minutes, with what has come since for one of them.
    assert {key: row.max_density for key, row in rows.items()} == {("Centre", "03:00"): 175 % 45, ("Nord", "03:00"): 175 % 45}
    assert rows["Nord", "03:00"].avg_pm25 < rows["Centre", "03:00"].avg_pm25


def test_series(spark, city, capsys):
    argv = ["series", "--serving", f"{city}/serving", "--district", "Centre", "--rows", "3"]
    rows = jobs.main(argv, spark)
    assert rows.count() == 17
    assert "predicted_pm25" in capsys.readouterr().out
    jobs.main([*argv, "--output", f"{city}/series"], spark)
    assert spark.read.parquet(f"{city}/series").count() == 17
    argv = ["series", "--serving", f"{city}/no-table", "--district", "Centre"]
    assert jobs.main(argv, spark).count() == 0


def test_history_writes_all_rows(spark, city):
    sql = "SELECT * FROM silver_traffic"
    argv = ["history", "--silver", f"{city}/silver", "--sql", sql, "--output", f"{city}/all"]
    jobs.main([*argv, "--format", "json"], spark)
    assert spark.read.json(f"{city}/all").count() == 72


def test_history(spark, city, capsys):
    sql = "SELECT district, count(*) AS n FROM silver_traffic GROUP BY district"
    rows = jobs.main(["history", "--silver", f"{city}/silver", "--sql", sql], spark)
    assert {(row.district, row.n) for row in rows.collect()} == {("Centre", 36), ("Nord", 36)}


def test_training_on_windows(spark, city):
    argv = f"train --silver {city}/silver --model {city}/model2 --train-on windows".split()
    assert jobs.main(argv, spark) is not None


def test_training_guard(spark, city, capsys):
    argv = f"train --silver {city}/silver --model {city}/none --min-rows 999999".split()
    assert jobs.main(argv, spark) is None
    assert "No model" in capsys.readouterr().out


def test_pack(spark, city, capsys):
    argv = ["pack", "--silver", f"{city}/silver", "--output", f"{city}/packed"]
    jobs.main([*argv, "--before", "2024-01-02"], spark)
    packed = read_history(spark, f"{city}/nothing", f"{city}/packed/traffic", "traffic")
    stored = read_silver(spark, f"{city}/silver/traffic", "traffic")
    assert packed.exceptAll(stored).isEmpty() and stored.exceptAll(packed).isEmpty()
    capsys.readouterr()
    jobs.main(argv, spark)
    assert "traffic: 0 files" in capsys.readouterr().out
    sql = "SELECT count(*) AS n FROM silver_traffic"
    argv = ["history", "--silver", f"{city}/silver", "--packed", f"{city}/packed", "--sql", sql]
    assert jobs.main(argv, spark).first().n == 72


def test_training_on_moments_and_on_packed_history(spark, city):
    argv = ["moments", "--silver", f"{city}/silver", "--output", f"{city}/moments", "--checkpoint", f"{city}/progress", "--once"]
    jobs.main(argv, spark)
    jobs.main(argv, spark)
    first = jobs.main(f"train --silver {city}/silver --model {city}/m1".split(), spark).stages[-1]
    for more in (f"--train-on moments --moments {city}/moments", f"--silver {city}/silver --packed {city}/packed"):
        other = jobs.main(f"train {more} --model {city}/m2".split(), spark).stages[-1]
        assert list(other.coefficients) == pytest.approx(list(first.coefficients)) and other.intercept == pytest.approx(first.intercept)
    with pytest.raises(SystemExit):
        jobs.main(f"train --model {city}/m3".split(), spark)


def test_fold(spark, city):
    before = serving.current(spark, f"{city}/serving").collect()
    jobs.main(["fold", "--serving", f"{city}/serving"], spark)
    after = serving.current(spark, f"{city}/serving").collect()
    assert sorted(before, key=repr) == sorted(after, key=repr) and len(after) == 34


def test_topics_need_servers(spark, city):
    with pytest.raises(SystemExit):
        jobs.main(f"bronze --output {city}/x --checkpoint {city}/y".split(), spark)


def test_checkpoint_is_required(spark, city):
    with pytest.raises(SystemExit):
        jobs.main(f"gold --source parquet --serving {city}/x".split(), spark)


def test_session_settings_name_no_master():
    assert session.SETTINGS["spark.sql.session.timeZone"] == "UTC"
    assert not any("master" in key for key in session.SETTINGS)
