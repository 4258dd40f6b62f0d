"""Every registered query of the library against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from grainmill.plans.catalog import FLAGSHIP, ORACLE_SQL, QUERIES

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else float(f"{x:.8g}")
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return float(f"{float(x):.8g}") if hasattr(x, "quantize") else x


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, str(SF))
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLE_SQL:
        want = db.sql(ORACLE_SQL[name])
        columns = list(want.columns)
        assert sorted(columns) == sorted(df.columns)
        assert table(rows, df.columns) == table(want.fetchall(), columns)


@pytest.mark.parametrize("name", ["d06_nearest_neighbour", "d07_redundancy"])
def test_redundancy_is_of_all_documents(spark, tmp_path, name):
    texts = [(i, f"a{i} b{i} c{i} d{i % 1500}" if i % 7 else "") for i in range(4100)]
    texts[-1] = (4099, texts[4051][1])
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want, df = con.sql(ORACLE_SQL[name]), QUERIES[name](spark, str(tmp_path))
    assert table([tuple(r) for r in df.collect()], df.columns) == table(want.fetchall(), list(want.columns))


def test_flagship_is_registered():
    assert FLAGSHIP in QUERIES and FLAGSHIP in ORACLE_SQL


def test_queries_are_listed_without_a_session():
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[1]
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=root, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr[-500:]
