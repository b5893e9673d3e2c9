"""Batch readers of the datasets at rest, always with an explicit schema."""

from pyspark.sql import functions as F

from kerbside import schemas


def read_bronze(spark, path, day=None):
    """Raw payloads; ``day`` (yyyy-MM-dd) prunes to one ingestion partition."""
    rows = spark.read.schema(schemas.BRONZE).json(path)
    return rows if day is None else rows.where(F.col("ingestion_date") == day)


def bronze_messages(bronze):
    """Stored payloads as messages again, to rebuild later layers from history."""
    return bronze.select(F.col("json_payload").alias("value"))


def read_silver(spark, path, feed):
    return spark.read.schema(schemas.SILVER[feed]).parquet(path)
