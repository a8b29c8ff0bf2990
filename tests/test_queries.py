"""Every named query against its SQL counterpart on the smallest data set."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from arcrelief.plans import catalogue, oracles

ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr([None if pd.isna(v) else v for v in r]) for r in frame.values.tolist())


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(ORACLES)
    assert set(catalogue.queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_matches_sql(spark, con, sf_dir, name):
    ours = entry.queries()[name](spark, sf_dir).toPandas()
    theirs = con.execute(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).columns == ["arc_id", "pos", "x", "y", "z"]
