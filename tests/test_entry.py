"""Every query with an oracle gives the oracle's rows on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    found = duckdb.connect()
    for t in TABLES:
        found.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return found


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, oracle, name):
    found = entry.queries()[name](spark, DATA)
    columns = sorted(found.columns)
    mine = sorted(str(tuple(str(r[c]) for c in columns)) for r in found.collect())
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted(str(tuple(str(dict(zip(names, r, strict=True))[c]) for c in columns)) for r in cursor.fetchall())
    assert mine == theirs


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
def test_flagship(spark):
    assert entry.entry(spark).count() > 0
