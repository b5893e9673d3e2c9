"""Session settings and the shared working folder.

Jobs take the session they are given. ``build`` is for entry points that own theirs;
it never names a master, so spark-submit decides where the work runs.
"""

import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Window state off the heap, checkpointed as change logs.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    **STATE_SETTINGS,
}


def build(app_name, extra=None):
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def use_utc(spark):
    """Event days and hours are UTC whatever the host's zone is."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_state_settings(spark):
    """For sessions built elsewhere: fill in what they leave open before a stateful start."""
    chosen = spark.conf.getAll
    for key, value in STATE_SETTINGS.items():
        if key not in chosen:
            spark.conf.set(key, value)


@contextmanager
def shuffle_partitions(spark, number):
    """Start streams inside: a stream keeps the number of its first start."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, number)
    try:
        yield
    finally:
        spark.conf.set(name, before)


_local_folder = None


def shared_folder(spark):
    """The folder in ``spark.checkpoint.dir``; where it is unset, one of this process.

    A local folder does for a session whose executors are in this process; on a cluster, of
    one machine or more, it would be visible to one process only, so that is refused.
    """
    global _local_folder
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="kerbside-")
    return _local_folder


def workspace(spark, label):
    """A fresh folder for intermediate tables, which ``remove_local_folder`` or the cluster's owner clears."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_local_folder():
    """Remove this process' own folder, if it made one, with all work folders in it."""
    global _local_folder
    if _local_folder is not None:
        shutil.rmtree(_local_folder, ignore_errors=True)
        _local_folder = None
