"""Findings of the third round: results on rows and sizes that the small tables lack."""

import shutil
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from linkloom.functions import text, urls
from linkloom.operators import search
from linkloom.queries import ORACLES, QUERIES

SMALL = Path("/root/testdata/sf0.001")


def same(spark, folder, name):
    con = duckdb.connect()
    for p in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = QUERIES[name](spark, str(folder))
    cols = sorted(got.columns)
    rows = Counter(str(tuple(r)) for r in got.select(*cols).collect())
    assert rows == Counter(map(str, con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLES[name]})").fetchall()))


@pytest.fixture(scope="module")
def sharp(tmp_path_factory):
    """The smallest tables with every other document beginning with ß."""
    folder = tmp_path_factory.mktemp("sharp")
    for p in SMALL.glob("*.parquet"):
        if p.stem != "documents":
            shutil.copy(p, folder / p.name)
    duckdb.execute(f"COPY (SELECT * REPLACE (CASE WHEN doc_id % 2 = 0 THEN 'ß' || text ELSE text END AS text) FROM '{SMALL}/documents.parquet') TO '{folder}/documents.parquet' (FORMAT parquet)")
    return folder


def test_a_capital_is_one_letter(spark):
    said = {"ßx": "ẞx", "ŉx": "ŉx", "ﬁx": "ﬁx", "ᾳx": "ᾼx", "ex": "Ex", "éx": "Éx", "": ""}
    rows = spark.createDataFrame([(s,) for s in said], "s string").select("s", urls.capital(F.col("s")).alias("c"), text.tidy(F.col("s")).alias("t")).collect()
    assert {r.s: r.c for r in rows} == said and {r.s: r.t for r in rows} == {s: c and c + "." for s, c in said.items()}


def test_tidied_texts_that_begin_with_sharp_s(spark, sharp):
    same(spark, sharp, "tidy_desc")


@pytest.mark.parametrize("name", ["publish_index", "publish_occurrences", "publish_per_channel"])
def test_publication_of_remarks_that_begin_with_sharp_s(spark, sharp, name):
    same(spark, sharp, name)


def test_nearest_ranks_few_of_the_pairs(spark, monkeypatch):
    """Ties, vectors without a similarity and queries without a vector rank as they do by the similarities of all pairs, of which few are ranked."""
    monkeypatch.setattr(search, "ROWS", 16)
    rows = [(i, [float(i % 7), float(i % 3), 1.0]) for i in range(200)] + [(200, None), (201, [1.0]), (202, [1.0, None, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    queries = spark.createDataFrame([(1, [1.0, 0.0, 0.0]), (2, [0.0, 1.0, 2.0]), (3, None)], "query_id long, q array<float>")
    for k in (5, 202):
        got = sorted((r.query_id, r["rank"], r.vec_id, r.similarity) for r in search.nearest(vectors, queries, k).collect())
        of = {}
        for r in search.similarities(vectors, queries).collect():
            of.setdefault(r.query_id, []).append((r.similarity is None, -(r.similarity or 0.0), r.vec_id, r.similarity))
        assert got == [(q, n, v, s) for q in sorted(of) for n, (_, _, v, s) in enumerate(sorted(of[q], key=lambda x: x[:3])[:k], 1)]
    assert "MapInArrow" in search.nearest(vectors, queries, 5)._jdf.queryExecution().toString()


def test_terms_begin_tokens(spark):
    docs = spark.createDataFrame([(1, "LICENSE-free mit"), (2, "relicense"), (3, "élicense é-licensed"), (4, "\U0001d400license"), (5, None), (6, "permit omit"), (7, "mi t")], "doc_id long, text string")
    one = search._hits(docs, "text", ["license", "mit", "mi", "c++"], 3, "doc_id").collect()
    assert {r.doc_id: tuple(r)[1:] for r in one} == {1: (True, True, False, False), 3: (True, False, False, False), 7: (False, False, True, False)} | {i: (False,) * 4 for i in (2, 4, 5, 6)}


def test_folded_works_out_only_what_is_asked_for(spark):
    plan = lambda name: QUERIES[name](spark, str(SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert "bits(" in plan("tag_union") and "bits(" not in plan("dedupe_survivor") and "<title" not in plan("first_last_seen")
