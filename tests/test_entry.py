"""The driver's contract: every query runs, and equals its oracle on a small scale."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: The training-data queries have tests of their own.
NAMES = sorted(set(entry.event_queries.ORACLES) & set(entry.queries()))


def plain(x):
    """Without the differences that pandas makes: nulls of any kind, and integers that turned into floats."""
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and math.isnan(x):
        return None
    return int(x) if isinstance(x, float) and x.is_integer() else x


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr([plain(x) for x in r]) for r in frame.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    got, want = entry.queries()[name](spark, SF).toPandas(), con.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).limit(5).count() == 5
