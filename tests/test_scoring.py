"""Saving, hot reload and null-safe scoring."""

import datetime

import pytest
from pyspark.sql import functions as F

from helpers import silver_pollution, silver_traffic
from kerbside.operators import scoring, training

START = datetime.datetime(2024, 1, 1)


def train(spark, factor=2):
    times = [START + datetime.timedelta(hours=i) for i in range(12)]
    traffic = [("Centre", time, 40 + i, 3 * i % 7) for i, time in enumerate(times)]
    pollution = [("Centre", time, factor * i) for i, time in enumerate(times)]
    return training.train_on_pairs(
        silver_traffic(spark, traffic), silver_pollution(spark, pollution)
    )


KPI = "district string, avg_speed double, max_density int, avg_pm25 double, alert_level string"


def kpi_rows(spark):
    return spark.createDataFrame(
        [
            ("Centre", 45.5, 3, 90.0, "CRITIQUE"),
            ("Nord", None, None, 60.0, "WARNING"),
            ("Sud", 50.0, 4, None, "NORMAL"),
        ],
        KPI,
    )


def test_scores_and_keeps_rows_without_features(spark, folder):
    scoring.save(train(spark), f"{folder}/model")
    model = scoring.LatestModel(spark, f"{folder}/model").get()
    line = model.stages[-1]
    rows = {row.district: row for row in scoring.score(kpi_rows(spark), model).collect()}
    assert len(rows) == 3
    expected = line.intercept + line.coefficients.dot([45.5, 3])
    assert rows["Centre"].predicted_pm25 == pytest.approx(expected)
    assert rows["Nord"].predicted_pm25 is None
    assert rows["Sud"].predicted_pm25 is not None
    assert rows["Nord"].asDict().keys() == {
        "district", "avg_speed", "max_density", "avg_pm25", "alert_level", "predicted_pm25",
    }


def test_missing_prediction_is_no_alert(spark):
    rows = scoring.with_alert_predicted(scoring.score(kpi_rows(spark), train(spark)))
    assert {row.district: row.alert_predicted for row in rows.collect()}["Nord"] == "NORMAL"


def test_without_a_model(spark, folder):
    assert scoring.LatestModel(spark, f"{folder}/none").get() is None
    rows = scoring.score(kpi_rows(spark), None)
    assert rows.where(F.col("predicted_pm25").isNull()).count() == 3


def test_reload_only_after_a_new_save(spark, folder):
    path = f"{folder}/model"
    latest = scoring.LatestModel(spark, path)
    assert latest.get() is None
    scoring.save(train(spark), path)
    first = latest.get()
    assert first is not None and latest.get() is first
    scoring.save(train(spark, 5), path)
    second = latest.get()
    assert second is not first
    assert second.stages[-1].coefficients != first.stages[-1].coefficients


def test_half_written_model_is_not_taken(spark, folder):
    path = f"{folder}/model"
    latest = scoring.LatestModel(spark, path)
    scoring.save(train(spark), path)
    first = latest.get()
    # What a save has on disk before its last file.
    first.stages[0].write().save(f"{path}/versions/partial/stages/0_assembler")
    assert latest.get() is first
    # A job that starts meanwhile has the earlier one as well.
    restarted = scoring.LatestModel(spark, path).get()
    assert restarted.stages[-1].coefficients == first.stages[-1].coefficients


def test_broken_model_is_an_error(spark, folder):
    scoring.point_to(f"{folder}/model", "gone")
    with pytest.raises(Exception):
        scoring.LatestModel(spark, f"{folder}/model").get()
