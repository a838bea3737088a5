"""Connected components against union-find, and the joins of a node with very many neighbours."""

import random

import pytest

from linkloom.llm import components


def plain(edges):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((top(u), top(v)))
            up[b] = a
    return {x: top(x) for x in up}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(None, 1), (2, None), (3, 3)],
        [(5, 4), (4, 5), (5, 4), (-1, 4)],
        [(k, k + 1) for k in range(60)],
        [(7, k) for k in range(200, 900)] + [(900, k) for k in range(899, 1200)],
        [(a, random.Random(a).randrange(400)) for a in range(0, 400, 2)],
    ],
    ids=["none", "nulls and loops", "repeated", "path", "two hubs", "random"],
)
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    assert sorted(tuple(r) for r in components.components(df).collect()) == sorted(plain(edges).items())


def test_adaptive_execution_splits_a_hub(spark):
    low = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    had = {k: spark.conf.get(k, None) for k in low}
    for k, v in low.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(1, 60000, numPartitions=8)
        # a large star is split at the smaller end, a small one at the larger
        low_hub, high_hub = df.selectExpr("id + 1 AS u", "if(id % 3 = 0, id, 0) AS v"), df.selectExpr("if(id % 3 = 0, id + 1, 100000) AS u", "id AS v")
        for step, edges in ((components._large_star, low_hub), (components._small_star, high_hub)):
            met = step(components.written(edges, "edges"))
            met.collect()
            assert "skew=true" in met._jdf.queryExecution().executedPlan().toString(), step.__name__
    finally:
        for k, v in had.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("at_once", [0, 60, 1000])
def test_rounds_and_one_task_agree(spark, at_once):
    edges = [(k, k + 1) for k in range(60)] + [(900, k) for k in range(400, 700)] + [(a, random.Random(a).randrange(2000, 2400)) for a in range(2000, 2400, 2)]
    df = spark.createDataFrame([*edges, (None, 5), (3, 3), (1, 0)], "u long, v long")
    assert sorted(tuple(r) for r in components.components(df, at_once=at_once).collect()) == sorted(plain(edges).items())


def test_few_edges_take_few_jobs(spark):
    df = components.written(spark.createDataFrame([(k, k + 1) for k in range(60)], "u long, v long"), "path")
    spark.sparkContext.setJobGroup("few-edges", "few edges")
    try:
        got = components.components(df).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.component for r in got} == {0} and len(got) == 61
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-edges")) <= 8
