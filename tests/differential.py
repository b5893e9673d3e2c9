"""Compare registered queries with their SQL twins, row by row."""

import glob
import os

import duckdb

import __spark_entry__ as spark_entry


def duck(sf_dir):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _key(row):
    return tuple(
        (value is None, str(type(value)), 0 if value is None else value) for value in row
    )


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(row) for row in frame.select(*names).collect()), key=_key)


def duck_rows(db, sql):
    result = db.execute(sql)
    order = sorted(range(len(result.description)), key=lambda i: result.description[i][0])
    names = [result.description[i][0] for i in order]
    return names, sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=_key)


def compare(spark, db, sf_dir, name):
    got = spark_rows(spark_entry.queries()[name](spark, sf_dir))
    want = duck_rows(db, spark_entry.oracle_sql()[name])
    return got, want
