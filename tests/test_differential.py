"""Every registered query gives exactly the rows of its SQL twin."""

import pytest

import __spark_entry__ as spark_entry
from differential import compare, duck_rows, spark_rows
from kerbside.plans import oracle, registry


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == oracle.sql().keys()
    assert registry.QUERIES.items() <= spark_entry.queries().items()
    assert oracle.sql().items() <= spark_entry.oracle_sql().items()


def test_entry_has_rows(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns[:2] == ["district", "window_end"]
    assert not frame.isEmpty()


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_matches_sql(spark, db, sf_dir, name):
    got, want = compare(spark, db, sf_dir, name)
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


@pytest.fixture
def parted(spark, sf_dir, folder):
    """The events as a folder of many files, as large tables are."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(6).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["kpi_1h", "kpi_stream_1h", "silver_traffic"])
def test_table_of_many_files(spark, db, sf_dir, parted, name):
    frame = spark_entry.queries()[name](spark, parted)
    assert spark_rows(frame) == duck_rows(db, spark_entry.oracle_sql()[name])


@pytest.mark.parametrize("name", ["kpi_1h", "kpi_stream_1h", "training_pairs"])
def test_host_time_zone_does_not_matter(spark, db, sf_dir, name):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    got, want = compare(spark, db, sf_dir, name)
    assert got == want
