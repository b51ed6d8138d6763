"""Every registered query against its SQL counterpart on whole tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from marketpulse.catalog import QUERIES
from marketpulse.oracle import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield con
    con.close()


def _key(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return type(a) is type(b) and a == b


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = sorted((tuple(row) for row in result.select(*columns).collect()), key=_key)
    cursor = duck.execute(ORACLES[name])
    names = [column[0] for column in cursor.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    theirs = sorted((tuple(row[i] for i in order) for row in cursor.fetchall()), key=_key)
    assert len(ours) == len(theirs)
    assert len(ours) > 0
    wrong = [(a, b) for a, b in zip(ours, theirs) if not all(map(_same, a, b))]
    assert not wrong, wrong[:3]


def test_flagship_gives_rows(spark):
    result = entry(spark)
    assert result.columns[:2] == ["ticker", "day"] and result.columns[-1] == "signal"
    assert result.count() == 366


def test_all_three_signals_occur(spark):
    counts = {row[0]: row[1] for row in QUERIES["investment_signal"](spark, SF_DIR).groupBy("signal").count().collect()}
    assert set(counts) == {"BUY", "SELL", "HOLD"}
