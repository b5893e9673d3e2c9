"""Small hand-written feeds."""

import json

from pyspark.sql import functions as F

from kerbside import schemas


def stamp(text):
    return f"2024-01-01T{text}.000Z"


def traffic(time="00:00:10", district="Centre", speed=50, count=10, **extra):
    return {
        "sensor_id": "cam_1",
        "district": district,
        "lat": 48.85,
        "lon": 2.35,
        "speed_kmh": speed,
        "vehicle_count": count,
        "timestamp": stamp(time) if time else time,
        **extra,
    }


def pollution(time="00:00:10", district="Centre", pm25=30, **extra):
    return {
        "sensor_id": "air_1",
        "district": district,
        "pm25": pm25,
        "co2": 420,
        "timestamp": stamp(time) if time else time,
        **extra,
    }


def messages(spark, rows):
    """Message bytes of payloads; text and None go in as they are."""
    texts = [row if row is None or isinstance(row, str) else json.dumps(row) for row in rows]
    return spark.createDataFrame([(text,) for text in texts], "value string").select(
        F.col("value").cast("binary").alias("value")
    )


def send(spark, rows, path):
    """Append messages to a feed folder as one file."""
    messages(spark, rows).coalesce(1).write.mode("append").parquet(path)


def silver_traffic(spark, rows):
    """Rows of (district, time, speed, count) as the cleaned dataset has them."""
    return spark.createDataFrame(
        [
            ("cam_1", 48.85, 2.35, speed, count, time, district)
            for district, time, speed, count in rows
        ],
        schemas.SILVER_TRAFFIC,
    )


def silver_pollution(spark, rows):
    return spark.createDataFrame(
        [("air_1", pm25, 420, time, district) for district, time, pm25 in rows],
        schemas.SILVER_POLLUTION,
    )
