"""Relation schemas. Sources are always read with these; nothing is inferred."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns):
    return StructType([StructField(name, kind(), True) for name, kind in columns.items()])


# Message payloads.
TRAFFIC = _struct(
    sensor_id=StringType,
    district=StringType,
    lat=DoubleType,
    lon=DoubleType,
    speed_kmh=IntegerType,
    vehicle_count=IntegerType,
    timestamp=StringType,
)
POLLUTION = _struct(
    sensor_id=StringType,
    district=StringType,
    pm25=IntegerType,
    co2=IntegerType,
    timestamp=StringType,
)
PAYLOADS = {"traffic": TRAFFIC, "pollution": POLLUTION}

# What the KPIs take from a payload.
KPI_PAYLOADS = {
    "traffic": StructType(
        [TRAFFIC[name] for name in ("district", "speed_kmh", "vehicle_count", "timestamp")]
    ),
    "pollution": StructType([POLLUTION[name] for name in ("district", "pm25", "timestamp")]),
}

# What tells how far a feed has come.
CLOCK = StructType([TRAFFIC["timestamp"]])

# Datasets at rest. The partition column comes last, as Spark reads it back.
BRONZE = _struct(
    json_payload=StringType, ingestion_time=TimestampType, ingestion_date=StringType
)
SILVER_TRAFFIC = _struct(
    sensor_id=StringType,
    lat=DoubleType,
    lon=DoubleType,
    speed_kmh=IntegerType,
    vehicle_count=IntegerType,
    event_time=TimestampType,
    district=StringType,
)
SILVER_POLLUTION = _struct(
    sensor_id=StringType,
    pm25=IntegerType,
    co2=IntegerType,
    event_time=TimestampType,
    district=StringType,
)
SILVER = {"traffic": SILVER_TRAFFIC, "pollution": SILVER_POLLUTION}

# Serving rows, keyed by (district, window_end).
SERVING = _struct(
    district=StringType,
    window_end=TimestampType,
    avg_speed=DoubleType,
    max_density=IntegerType,
    avg_pm25=DoubleType,
    predicted_pm25=DoubleType,
    alert_level=StringType,
    alert_predicted=StringType,
)
SERVING_KEY = ["district", "window_end"]
SERVING_LOG = StructType(
    SERVING.fields
    + [
        StructField("run_id", LongType(), True),
        StructField("batch_id", LongType(), True),
    ]
)
