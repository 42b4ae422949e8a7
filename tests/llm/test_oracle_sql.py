"""The operators' queries against their SQL, on the tables at which the SQL is affordable."""

from __future__ import annotations

import duckdb
import pytest

from loomwork.llm.oracle import ORACLE
from loomwork.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    got = con.execute(ORACLE[name])
    columns = [c[0] for c in got.description]
    want = sorted(tuple(r) for r in got.fetchall())
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == want and want
