"""Queries that take whole inputs, against plain versions."""

from pyspark.sql import functions as F

from linkloom.operators import search
from linkloom.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def vectors(spark):
    return {r.vec_id: [float(x) for x in r.embedding] for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()}


def ranked(v, q):
    sims = [(round(sum(a * b for a, b in zip(x, v[q])), 6), i) for i, x in v.items()]
    return sorted(sims, key=lambda s: (-s[0], s[1]))


def test_fusion_keeps_every_hit(spark):
    words = sorted(QUERIES["keyword_synonym_search"](spark, DATA).collect(), key=lambda r: (-r.literal, -r.score, r.doc_id))
    near = [i for _, i in ranked(vectors(spark), 0)]
    a, b = {r.doc_id: n for n, r in enumerate(words, 1)}, {i: n for n, i in enumerate(near, 1)}
    got = {r.doc_id: r.score for r in QUERIES["rrf_fusion"](spark, DATA).collect()}
    assert len(b) > 100 and got.keys() == a.keys() | b.keys()
    assert all(abs(s - sum(1 / (60 + x[i]) for x in (a, b) if i in x)) < 1e-5 for i, s in got.items())


def test_every_hundredth_vector_is_a_query(spark, monkeypatch):
    v = vectors(spark)
    asked = {i for i in v if i % 100 == 0}
    for block in (10_000, 2):
        monkeypatch.setattr(search, "BLOCK", block)
        got = {(r.query_id, r["rank"]): r.similarity for r in QUERIES["vector_topk"](spark, DATA).collect()}
        assert len(asked) > 3 and got.keys() == {(q, n) for q in asked for n in range(1, 6)}
        assert all(abs(s - ranked(v, q)[n - 1][0]) < 2e-6 for (q, n), s in got.items())
    assert {r.query_id for r in QUERIES["probe_stats"](spark, DATA).collect()} == asked


def test_tidy_takes_whole_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.length("text") > 500)
    rows = docs.join(QUERIES["tidy_desc"](spark, DATA), "doc_id").select("text", "tidy").collect()
    assert rows and all(len(r.tidy) > 402 and r.tidy.rstrip(".")[-20:] == r.text.strip().rstrip(".")[-20:] for r in rows if len(r.text.strip()) > 500)
