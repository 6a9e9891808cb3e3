"""Every query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from sessionloom.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(map(repr, frame.itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    ours = QUERIES[name](spark, SF_DIR).toPandas()
    theirs = sql.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert comparable(ours) == comparable(theirs)
    assert len(ours) > 0


def test_entry(spark):
    got = entry_points.entry(spark).collect()
    assert len(got) == 1 and got[0]["viewed_sessions"] > 0


def test_entry_points_hold_the_catalogue():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())
