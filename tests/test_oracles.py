"""Every registered query against its SQL on the smallest data set; the rest must return rows."""

import glob
import os

import duckdb
import pytest

from check_oracle import rows
from __spark_entry__ import entry, oracle_sql, queries
from given import SMALL

# model training and search, covered by test_models.py; the SQL-backed queries all run here
SLOW = {n for n in queries() if n[0] in "MCE" and n not in ("M17_score_stream", "E12_sampled_attributions")} | {"FE17_impute_chained"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    got = rows(queries()[name](spark, SMALL).toArrow())
    want = rows(con.execute(oracle_sql()[name]).to_arrow_table())
    assert got[0] == want[0]
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql()) - SLOW))
def test_returns_rows(spark, name):
    assert queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert entry(spark).count() == 24


def test_oracles_have_queries():
    assert set(oracle_sql()) <= set(queries())
