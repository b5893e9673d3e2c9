"""The folded training set against all pairs written out by brute force."""

import datetime
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from helpers import silver_pollution, silver_traffic
from kerbside.operators import training
from kerbside.operators.kpis import kpis, unify

START = datetime.datetime(2024, 1, 1)


def history(seed, hot=False):
    """Random feeds with gaps, nulls and, if asked, one district that holds most rows."""
    draw = random.Random(seed)
    districts = ["Centre", "Nord", "Sud", None]

    def place():
        return "Centre" if hot and draw.random() < 0.6 else draw.choice(districts)

    def time():
        minutes = 30 if hot and draw.random() < 0.5 else draw.randrange(300)
        return None if draw.random() < 0.05 else START + datetime.timedelta(minutes=minutes)

    def measure(top):
        return None if draw.random() < 0.1 else draw.randrange(top)

    traffic = [(place(), time(), measure(130), measure(50)) for _ in range(150)]
    pollution = [(place(), time(), measure(100)) for _ in range(90)]
    return traffic, pollution


def brute_pairs(traffic, pollution):
    def hour(time):
        return time.replace(minute=0, second=0)

    return [
        (float(speed), float(count), float(pm25))
        for district, time, speed, count in traffic
        for other, when, pm25 in pollution
        if None not in (district, time, speed, count, other, when, pm25)
        and district == other
        and hour(time) == hour(when)
    ]


def brute_line(spark, pairs):
    rows = spark.createDataFrame(pairs, "speed_kmh double, vehicle_count double, label double")
    assembler = VectorAssembler(inputCols=training.FEATURES, outputCol="features")
    fitted = Pipeline(stages=[assembler, LinearRegression(maxIter=10, regParam=0.3)]).fit(rows)
    return line(fitted)


def line(model):
    return [*model.stages[-1].coefficients, model.stages[-1].intercept]


def frames(spark, traffic, pollution):
    return silver_traffic(spark, traffic), silver_pollution(spark, pollution)


@pytest.mark.parametrize("seed, hot", [(1, False), (2, False), (3, True), (4, True)])
def test_same_line_as_all_pairs(spark, seed, hot):
    traffic, pollution = history(seed, hot)
    pairs = brute_pairs(traffic, pollution)
    model = training.train_on_pairs(*frames(spark, traffic, pollution))
    assert line(model) == pytest.approx(brute_line(spark, pairs), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("seed", [5, 6])
def test_same_totals_as_all_pairs(spark, seed):
    traffic, pollution = history(seed, True)
    pairs = brute_pairs(traffic, pollution)
    totals = training.pair_totals(training.paired_hours(*frames(spark, traffic, pollution))).first()
    assert tuple(totals) == (len(pairs), *[sum(column) for column in zip(*pairs)])


def test_moment_rows_keep_count_means_and_covariances(spark):
    traffic, pollution = history(7)
    rows = training.moment_rows(training.paired_hours(*frames(spark, traffic, pollution)))
    got = rows.collect()
    pairs = brute_pairs(traffic, pollution)
    weight = sum(row.weight for row in got)
    assert weight == 6 * len(pairs)

    def moments(points):
        total = sum(w for w, _ in points)
        means = [sum(w * p[i] for w, p in points) / total for i in range(3)]
        return means + [
            sum(w * (p[i] - means[i]) * (p[j] - means[j]) for w, p in points) / total
            for i in range(3)
            for j in range(i, 3)
        ]

    assert moments([(r.weight, (r.speed_kmh, r.vehicle_count, r.label)) for r in got]) == (
        pytest.approx(moments([(1, pair) for pair in pairs]))
    )


def test_constant_speed_and_constant_label(spark):
    traffic = [("Centre", START, 50, count) for count in range(8)]
    varied = [("Centre", START, pm25) for pm25 in (10, 20, 40)]
    pairs = brute_pairs(traffic, varied)
    model = training.train_on_pairs(*frames(spark, traffic, varied))
    assert line(model) == pytest.approx(brute_line(spark, pairs), abs=1e-9)
    constant = [("Centre", START, 33)] * 3
    model = training.train_on_pairs(*frames(spark, traffic, constant))
    assert line(model) == [0, 0, 33]


@pytest.mark.parametrize("count, trained", [(9, False), (10, True)])
def test_fewest_pairs(spark, count, trained):
    traffic = [("Centre", START, 40 + i, i) for i in range(count)]
    model = training.train_on_pairs(*frames(spark, traffic, [("Centre", START, 20)]))
    assert (model is not None) == trained


def test_no_pairs(spark):
    feeds = frames(spark, [("Centre", START, 40, 4)], [("Nord", START, 20)])
    assert training.train_on_pairs(*feeds) is None


def test_training_on_windows(spark):
    times = [START + datetime.timedelta(minutes=i) for i in range(12)]
    traffic = [("Centre", time, 40 + i % 7, i) for i, time in enumerate(times)]
    pollution = [("Centre", time, 3 * i + i % 5) for i, time in enumerate(times)]
    windows = kpis(unify(*frames(spark, traffic, pollution)))
    model = training.train_on_windows(windows)
    assert line(model) == pytest.approx(
        brute_line(spark, brute_pairs_by_minute(traffic, pollution)), abs=1e-9
    )
    assert training.train_on_windows(windows.limit(9)) is None


def brute_pairs_by_minute(traffic, pollution):
    return [(float(t[2]), float(t[3]), float(p[2])) for t, p in zip(traffic, pollution)]


def test_model_parameters(spark):
    traffic, pollution = history(8)
    assembler, regression = training.train_on_pairs(*frames(spark, traffic, pollution)).stages
    assert assembler.getInputCols() == ["speed_kmh", "vehicle_count"]
    assert assembler.getHandleInvalid() == "keep"
    assert (regression.getMaxIter(), regression.getRegParam()) == (10, 0.3)
    assert (regression.getElasticNetParam(), regression.getSolver()) == (0.0, "auto")
    assert regression.getFitIntercept() and regression.getStandardization()


def test_pairs_are_never_written_out(spark):
    """A hot hour of 2000 x 2000 events stays one row on either side of the join."""
    ids = spark.range(2000)
    time = F.lit(START).cast("timestamp").alias("event_time")
    measure = (F.col("id") % 90).cast("int")
    place = F.lit("Centre").alias("district")
    traffic = ids.select(place, time, measure.alias("speed_kmh"), measure.alias("vehicle_count"))
    pollution = ids.select(place, time, measure.alias("pm25"))
    hours = training.paired_hours(traffic, pollution)
    assert [row.pairs for row in hours.collect()] == [4_000_000]
    assert training.moment_rows(hours).count() == 6
