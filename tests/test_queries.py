"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from spheremeans.catalog.oracles import ORACLES
from spheremeans.catalog.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def _comparable(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got_df = QUERIES[name](spark, SF_DIR)
    got = _comparable(got_df.toPandas())
    want_rel = duck.sql(ORACLES[name])
    want = _comparable(want_rel.df())
    assert list(got.columns) == list(want.columns)
    kinds = dict(zip(want_rel.columns, map(str, want_rel.types), strict=True))
    names = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}
    assert dict(got_df.dtypes) == {c: names[t] for c, t in kinds.items()}
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, want, check_dtype=False, check_exact=True)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
