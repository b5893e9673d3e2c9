"""Saving, loading and applying the PM2.5 model.

A model's folder holds one folder for each version ever saved and pointers to them. A pointer is
written last, in one step, so what it names is complete, and a version is never changed.
"""

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kerbside.functions.rules import alert_predicted

TO_MODEL = {"avg_speed": "speed_kmh", "max_density": "vehicle_count"}
FROM_MODEL = {name: kpi for kpi, name in TO_MODEL.items()}


POINTER = "saved_ns long, version string"


def save(model, path):
    """Add a version to the model at ``path`` and point to it. Until then the one before stays in use."""
    version = uuid.uuid4().hex
    model.write().save(f"{path}/versions/{version}")
    point_to(path, version)


def point_to(path, version):
    spark = SparkSession.getActiveSession()
    row = spark.createDataFrame([(time.time_ns(), version)], POINTER).coalesce(1)
    row.write.mode("append").json(f"{path}/pointers")


class LatestModel:
    """The model at a path, read again only when another version is pointed to.

    ``get`` returns None while there is none, and the last one published while another is being
    written, also in a process that starts meanwhile. Failures are raised.
    """

    def __init__(self, spark, path):
        self.spark = spark
        self.path = path
        self.version = None
        self.model = None

    def _version(self):
        """The version pointed to last: one small row for each save."""
        try:
            pointers = self.spark.read.schema(POINTER).json(f"{self.path}/pointers")
            newest = pointers.agg(F.max(F.struct("saved_ns", "version"))["version"]).first()
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        return newest[0]

    def get(self):
        version = self._version()
        if version is not None and version != self.version:
            self.model = PipelineModel.load(f"{self.path}/versions/{version}")
            self.version = version
        return self.model


def score(kpi, model):
    """KPI rows with ``predicted_pm25``, null where a feature is or where no model exists.

    A null feature comes out of the model as NaN, which compares above every number, so it
    is turned back into null before any rule sees it.
    """
    null = F.lit(None).cast("double")
    if model is None:
        return kpi.withColumn("predicted_pm25", null)
    return (
        model.transform(kpi.withColumnsRenamed(TO_MODEL))
        .withColumnsRenamed(FROM_MODEL)
        .withColumn("predicted_pm25", F.nanvl("prediction", null))
        .drop("features", "prediction")
    )


def with_alert_predicted(scored):
    return scored.withColumn(
        "alert_predicted", alert_predicted(F.col("predicted_pm25"), F.col("max_density"))
    )


def coefficients(spark, model):
    """The fitted line as a one-row DataFrame."""
    line = model.stages[-1]
    return spark.createDataFrame(
        [(*map(float, line.coefficients), float(line.intercept))],
        "speed_coefficient double, vehicle_coefficient double, intercept double",
    )
