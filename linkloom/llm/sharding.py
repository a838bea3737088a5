"""Sharding by rendezvous hashing over weighted shards."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import numbered, table, unit


def rendezvous(key: Column, weights: list[float], seed: int = 0) -> Column:
    """The shard, 0 to len(weights) - 1, whose score -weight / ln(u) is the highest, u being a hash of (key, shard).

    A shard's score depends on nothing but the key, its number and its weight: a shard that is added at
    the end takes rows only into itself, and one whose weight falls only gives rows away. A null key is
    a key of its own. Equal scores go to the lower shard.
    """
    if not weights or any(w < 0 or not math.isfinite(w) for w in weights) or not any(weights):
        raise ValueError("weights must be finite, not negative and not all 0")

    def score(shard: int, weight: float) -> Column:
        return F.lit(float(weight)) / -F.log(unit(F.lit(seed), F.lit(shard), F.coalesce(key.cast("string"), F.lit("null"))))

    best = F.struct(score(0, weights[0]).alias("s"), F.lit(0).alias("n"))
    ranked = [F.struct(score(k, w).alias("s"), F.lit(-k).alias("n")) for k, w in enumerate(weights)]
    ranked[0] = best
    return -F.greatest(*ranked)["n"] if len(ranked) > 1 else F.lit(0)


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", weights: list[float] | None = None, seed: int = 0) -> DataFrame:
    """Columns key, size, text_crc32, law, shard, slot and grown_shard of every row of docs.

    size is the text's UTF-8 bytes plus 1 (a null text has none), text_crc32 the unsigned CRC-32 of those
    bytes (0 of a null text). slot numbers the rows of a shard from 0 by key, without gaps; rows that repeat a key
    take neighbouring slots. grown_shard is the shard once one more of the mean weight is added. Null keys
    share a shard; an empty table gives no rows; other columns of docs are not read.
    """
    weights = weights or [1.0] * shards
    grown = [*weights, sum(weights) / len(weights)]
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col(key), weights, seed).cast("int").alias("shard"),
        rendezvous(F.col(key), grown, seed).cast("int").alias("grown_shard"),
    )
    out = numbered(rows, ["shard"], ["doc_id", "text_crc32", "size"], "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 16, key: str = "doc_id", weights: list[float] | None = None, seed: int = 0) -> None:
    """docs as Parquet under path/shard=N, every row whole. Rows of one shard may come in several files."""
    docs.withColumn("shard", rendezvous(F.col(key), weights or [1.0] * shards, seed).cast("int")).write.partitionBy("shard").parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's size, checksum and place in 16 shards, and its shard if there were 17."""
    return shard(table(spark, sf_dir, "documents"), 16)


# DuckDB has no CRC-32, so it is reckoned byte by byte with the table of its polynomial.
OP5_SQL = """
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
d AS (SELECT doc_id, text, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS b FROM documents),
keyed AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size, xor(4294967295, list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1]))) AS text_crc32,
list_transform(range(17), lambda s: (CAST('0x' || substr(md5('0:' || s || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS u FROM d, crc),
dealt AS (SELECT doc_id, size, text_crc32, CAST(list_position(u, list_max(u[1:16])) - 1 AS INTEGER) AS shard, CAST(list_position(u, list_max(u)) - 1 AS INTEGER) AS grown_shard FROM keyed)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard FROM dealt
"""
