"""Training the PM2.5 model on history.

The training set pairs every traffic event with every pollution event of the same district
and hour. A least-squares fit sees a training set only through its count, means and
covariances, and those of all n x m pairs of an hour follow from the n and the m rows taken
apart: means carry over, and traffic and pollution are uncorrelated within the hour. So both
sides are folded to one row per (district, hour) before they meet, and the model comes out
as if the pairs had been written out, at a cost linear in the events.
"""

from functools import reduce
from operator import and_

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

FEATURES = ["speed_kmh", "vehicle_count"]
MIN_ROWS = 10
HOUR = ["district", "hour"]


def complete_hours(rows, *measures):
    """Events complete in what training needs, with their hour.

    Spelled out column by column, as Parquet takes these filters and not those of ``dropna``.
    """
    complete = reduce(and_, [F.col(c).isNotNull() for c in ("district", "event_time", *measures)])
    return rows.where(complete).withColumn("hour", F.date_trunc("hour", "event_time"))


def traffic_hours(traffic):
    """Count, sums and moments of the complete traffic events of each district and hour."""
    return (
        complete_hours(traffic, *FEATURES)
        .groupBy(HOUR)
        .agg(
            F.count(F.lit(1)).alias("n_traffic"),
            F.sum("speed_kmh").alias("speed_sum"),
            F.sum("vehicle_count").alias("vehicle_sum"),
            F.avg("speed_kmh").alias("speed_mean"),
            F.avg("vehicle_count").alias("vehicle_mean"),
            F.var_pop("speed_kmh").alias("speed_var"),
            F.var_pop("vehicle_count").alias("vehicle_var"),
            F.covar_pop("speed_kmh", "vehicle_count").alias("covar"),
        )
    )


def pollution_hours(pollution):
    return (
        complete_hours(pollution, "pm25")
        .groupBy(HOUR)
        .agg(
            F.count(F.lit(1)).alias("n_pollution"),
            F.sum("pm25").alias("pm25_sum"),
            F.avg("pm25").alias("pm25_mean"),
            F.var_pop("pm25").alias("pm25_var"),
        )
    )


def paired_hours(traffic, pollution):
    """The inner join on (district, hour): one row per hour, ``pairs`` rows standing behind it.

    Pair counts grow with the square of the feeds and pass a 64-bit integer on large ones,
    so they are doubles.
    """
    return joined_hours(traffic_hours(traffic), pollution_hours(pollution))


def joined_hours(traffic, pollution):
    pairs = F.col("n_traffic").cast("double") * F.col("n_pollution")
    return traffic.join(pollution, HOUR, "inner").withColumn("pairs", pairs)


def pair_totals(hours, *keys):
    """Row count and column sums of the pairs behind ``hours``, per ``keys``."""
    return hours.groupBy(*keys).agg(
        F.sum("pairs").alias("pairs"),
        *[
            F.sum(F.col(total).cast("double") * F.col(partners)).alias(name)
            for name, total, partners in (
                ("speed_sum", "speed_sum", "n_pollution"),
                ("vehicle_sum", "vehicle_sum", "n_pollution"),
                ("label_sum", "pm25_sum", "n_traffic"),
            )
        ],
    )


def moment_rows(hours):
    """Six weighted rows per hour with the mean and covariance of its pairs.

    They sit at sqrt(3) along the three columns of the covariance's square root: two for the
    correlated traffic measures, one for the label.
    """
    spread = F.sqrt(F.lit(3.0))
    speed = F.sqrt("speed_var")
    # A constant speed has no covariance either.
    shared = F.coalesce(F.try_divide(F.col("covar"), speed), F.lit(0.0))
    vehicle = F.sqrt(F.greatest(F.col("vehicle_var") - shared * shared, F.lit(0.0)))
    label = F.sqrt("pm25_var")
    zero = F.lit(0.0)

    def row(sign, *steps):
        means = ("speed_mean", "vehicle_mean", "pm25_mean")
        names = (*FEATURES, "label")
        return F.struct(
            *[
                (F.col(mean) + sign * spread * step).alias(name)
                for mean, step, name in zip(means, steps, names)
            ]
        )

    steps = [(speed, shared, zero), (zero, vehicle, zero), (zero, zero, label)]
    rows = F.explode(F.array(*[row(sign, *step) for step in steps for sign in (1, -1)]))
    return hours.select(F.col("pairs").alias("weight"), rows.alias("r")).select(
        "weight", "r.*"
    )


def window_rows(kpi):
    """The other training set: windows as they will be scored, one row each."""
    return kpi.select(
        F.lit(1.0).alias("weight"),
        F.col("avg_speed").alias("speed_kmh"),
        F.col("max_density").cast("double").alias("vehicle_count"),
        F.col("avg_pm25").alias("label"),
    ).dropna()


def fit(rows):
    """Ridge regression on weighted rows.

    With two features and no L1 term the solver takes the normal equations, summed over the
    executors; ``maxIter`` then has no effect. Nulls are let through at scoring time.
    """
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    regression = LinearRegression(maxIter=10, regParam=0.3, weightCol="weight")
    return Pipeline(stages=[assembler, regression]).fit(rows)


def train_on_pairs(traffic, pollution, min_rows=MIN_ROWS):
    """The fitted model, or None when fewer than ``min_rows`` pairs exist."""
    return train_on_hours(traffic_hours(traffic), pollution_hours(pollution), min_rows)


def train_on_hours(traffic, pollution, min_rows=MIN_ROWS):
    """The same from the hours of both feeds."""
    hours = joined_hours(traffic, pollution).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if (pair_totals(hours).first()["pairs"] or 0) < min_rows:
            return None
        return fit(moment_rows(hours))
    finally:
        hours.unpersist()


def train_on_windows(kpi, min_rows=MIN_ROWS):
    """The same from complete KPI windows."""
    rows = window_rows(kpi).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if rows.limit(min_rows).count() < min_rows:
            return None
        return fit(rows)
    finally:
        rows.unpersist()
