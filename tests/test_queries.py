"""Every registered query against its SQL."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from ratewatch.plans.oracles import ORACLES
from ratewatch.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=frame.index)
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            out[name] = [None if pd.isna(v) else pd.Timestamp(v).isoformat() for v in column]
        else:
            out[name] = [None if pd.isna(v) else repr(v.item() if hasattr(v, "item") else v) for v in column]
    return out.astype(str).sort_values(list(out.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf, name):
    ours = QUERIES[name](spark, sf).toPandas()
    theirs = duck.sql(ORACLES[name]).df()
    pd.testing.assert_frame_equal(comparable(ours), comparable(theirs))


def test_entry_gives_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
