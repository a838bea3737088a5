"""The queries that SQL can express, against their SQL in DuckDB on whole tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from linkloom.llm.queries import ORACLES, QUERIES

DATA = Path(os.environ.get("LINKLOOM_TESTDATA", "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    df = QUERIES[name](spark, str(DATA))
    cols = sorted(df.columns)
    assert Counter(str(tuple(r)) for r in df.select(*cols).collect()) == Counter(map(str, con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()))
