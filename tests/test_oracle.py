"""Every query with an oracle gives the oracle's rows."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    con.execute("set timezone = 'UTC'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if os.environ.get("ONLY", "") in n))
def test_query_equals_oracle(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    got = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, got.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
