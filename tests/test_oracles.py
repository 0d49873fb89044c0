"""Every registered query against its SQL on DuckDB, over whole tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from tidemark.plans import oracles, registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    for column in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[column]):
            frame = frame.assign(**{column: frame[column].astype("datetime64[us]")})
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.ORACLES)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, duck, name):
    ours = canonical(contract.queries()[name](spark, SF_DIR).toPandas())
    theirs = canonical(duck.sql(contract.oracle_sql()[name]).df())
    assert len(ours) > 0
    assert list(ours.columns) == list(theirs.columns)
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False, check_exact=True)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
