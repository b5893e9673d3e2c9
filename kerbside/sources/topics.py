"""Message feeds as streaming DataFrames with a ``value`` column."""

from pyspark.sql.types import BinaryType, StructField, StructType

MESSAGE = StructType([StructField("value", BinaryType(), True)])


def read_topic(spark, topic, servers, starting_offsets="earliest", **options):
    """One topic of a message broker (needs the Kafka connector on the classpath).

    Pass ``maxOffsetsPerTrigger`` to bound a micro-batch and ``minPartitions`` to read a
    topic with more tasks than it has partitions.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
        .load()
    )


def read_message_files(spark, path, fmt="parquet", **options):
    """The same feed from files: text (one message a line) or Parquet with ``value`` bytes."""
    reader = spark.readStream.format(fmt).options(**options)
    if fmt != "text":
        reader = reader.schema(MESSAGE)
    return reader.load(path)
