"""Every query against its SQL in DuckDB on the smallest tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from linkloom.queries import ORACLES, QUERIES

DATA = Path(os.environ.get("LINKLOOM_TESTDATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    rows = Counter(str(tuple(r)) for r in df.select(*cols).collect())
    if name in ORACLES:
        assert rows == Counter(map(str, duck.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()))
    elif name != "empty_gate":
        assert rows
