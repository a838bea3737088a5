"""Connected components by alternating large-star and small-star steps, all on the executors; few edges are joined by one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import written

#: Edges, of 16 bytes each, that one task joins at most; above them every step is shared out.
AT_ONCE = 1 << 20


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _met(ends: DataFrame, least: DataFrame) -> DataFrame:
    """Each end v of a node u beside the node's minimum. The minima come from a written table: between two plain exchanges adaptive
    execution can split the partition of a node with very many neighbours, above an aggregate it can't."""
    return ends.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    near = _both(edges)
    least = written(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
    return _met(near.where("v > u"), least)


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "minima")
    return _met(down, least).union(least.select("u", F.col("m").alias("v")))


def _joined(edges: DataFrame) -> DataFrame:
    """The components of at most AT_ONCE edges, by one task's union-find."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.stack([batch.column(c).to_numpy() for c in ("u", "v")]) for batch in batches if len(batch)]
        if not held:
            return
        ids, code = np.unique(np.concatenate(held, axis=1), return_inverse=True)
        up = list(range(len(ids)))

        def top(x: int) -> int:
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        for u, v in zip(*code.reshape(2, -1).tolist(), strict=True):
            a, b = top(u), top(v)
            up[max(a, b)] = min(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[[top(x) for x in range(len(ids))]])], ["id", "component"])

    return written(edges.select("u", "v").coalesce(1).mapInArrow(run, "id long, component long"), "joined")


def components(edges: DataFrame, rounds: int = 40, at_once: int = AT_ONCE) -> DataFrame:
    """Edges (u, v: long) to (id, component), component being the smallest id reachable; only ids that have an edge.

    Null ends and loops are ignored, repeated edges count once, no edges give no rows. Edges go through rounds of steps until none changes or at most
    at_once are left, which one task joins: a round has many small jobs. A node with very
    many neighbours only meets partial minima and joins that adaptive execution can split once a partition is past its limits.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    if edges.count() <= at_once:
        return _joined(edges)
    before = None
    for _ in range(rounds):
        edges = written(_small_star(written(_large_star(edges), "stars")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        if now[0] <= at_once:
            return _joined(edges)
        before = now
    else:
        raise RuntimeError("connected components didn't settle")
    ids = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
