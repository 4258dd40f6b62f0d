"""Queries of the subpackage against their SQL, on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from grainmill.llm.queries import ORACLE_SQL, QUERIES

from ..test_queries import SF, table


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, str(SF))
    want = con.sql(ORACLE_SQL[name])
    columns = list(want.columns)
    assert sorted(columns) == sorted(df.columns)
    assert table([tuple(r) for r in df.collect()], df.columns) == table(want.fetchall(), columns)
