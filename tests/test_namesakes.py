"""Queries whose corpora need names that tell things apart, over more numbers than there are names."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def many(tmp_path_factory):
    """Streets of a town and vectors whose numbers are 8,000 apart."""
    top = tmp_path_factory.mktemp("many")
    con = duckdb.connect()
    tables = {
        "nation": "select n::int as n_nationkey from range(25) t(n)",
        "supplier": "select s::bigint as s_suppkey, (s % 25)::int as s_nationkey from range(10) t(s)",
        "part": "select p::bigint as p_partkey from range(8100) t(p)",
        "lineitem": "select 1::bigint as l_orderkey, 1::bigint as l_partkey, 1::bigint as l_suppkey, 1 as l_linenumber",
        "embeddings": "select v::bigint as vec_id, [((v * 37 % 8009) / 4000.0)::float, ((v * 101 % 8011) / 4000.0)::float] as embedding, 0 as label from range(8100) t(v)",
    }
    for name, sql in tables.items():
        con.execute(f"copy ({sql}) to '{top}/{name}.parquet'")
        con.execute(f"create view {name} as select * from '{top}/{name}.parquet'")
    return con, str(top)


@pytest.mark.parametrize("name", ["d02_addresses", "d08_conflicts", "r30_canonical_names"])
def test_namesakes_are_told_apart(spark, many, name):
    con, top = many
    df = entry.queries()[name](spark, top)
    want = con.execute(entry.oracle_sql()[name])
    assert df.columns == [c[0] for c in want.description]
    rows = sorted(want.fetchall(), key=repr)
    assert rows
    assert sorted(map(tuple, df.collect()), key=repr) == rows
