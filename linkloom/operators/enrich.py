"""The link cache: what to fetch, what to drop, what was researched."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html, urls
from .ordering import numbered


def wanted(sightings: DataFrame) -> DataFrame:
    """(key, url): the first URL of each destination by seq, furniture left out."""
    # the first sighting of each URL, then of each key: URL expressions run once for each URL
    first = sightings.groupBy("url").agg(F.min("seq").alias("seq")).where(~urls.is_furniture(F.col("url")))
    rows = first.withColumn("key", urls.canonical_key(F.col("url"))).where("key is not null")
    return rows.groupBy("key").agg(F.min(F.struct("seq", "url")).alias("m")).select("key", "m.url", F.col("m.seq").alias("seq"))


def worklist(want: DataFrame, cache: DataFrame, asof: str, retry: bool = False, refetch: str | None = None, days: int = 30, limit: int | None = None) -> DataFrame:
    """What to fetch: missing, asked for, or failed and old; titled and researched rows stay unless asked for. limit takes the first by seq."""
    c = cache.select(F.col("key").alias("_k"), F.col("url").alias("_url"), "ok", "title", "via", "fetched_at")
    rows = want.join(c, F.col("key") == F.col("_k"), "left")
    titled = F.coalesce("title", F.lit("")) != ""
    old = F.col("fetched_at").cast("timestamp") < F.lit(asof).cast("timestamp") - F.expr(f"INTERVAL {int(days)} DAYS")
    asked = F.coalesce("_url", "url").rlike(refetch) if refetch else F.lit(False)
    keep = F.when(F.col("_k").isNull(), True).when(asked, True).when(F.coalesce("ok", F.lit(False)) & (titled | F.lit(not retry)), False).when((F.coalesce("via", F.lit("")) == "agent") & titled, False).otherwise(F.lit(retry) | old)
    rows = rows.where(keep).select("key", "url", "seq")
    return rows if limit is None else rows.orderBy("seq", "key").limit(limit)


def pruned(cache: DataFrame, want: DataFrame) -> DataFrame:
    return cache.join(want.select("key"), "key", "left_semi")


def gaps(cache: DataFrame) -> DataFrame:
    return cache.where(F.coalesce("title", F.lit("")) == "")


def merged(cache: DataFrame, researched: DataFrame, asof: str) -> DataFrame:
    """The cache with researched titles, only where a row has none: (key, title, description) never add rows."""
    r = researched.select(F.col("key").alias("_k"), F.trim("title").alias("_t"), F.trim(F.regexp_replace(F.coalesce("description", F.lit("")), r"\s+", " ")).alias("_d")).where("_t <> ''")
    new = (F.coalesce("title", F.lit("")) == "") & F.col("_k").isNotNull()
    out = cache.join(r, F.col("key") == F.col("_k"), "left")
    put = {"ok": F.lit(True), "title": F.substring("_t", 1, 160), "description": html.blurb(F.col("_d")), "via": F.lit("agent"), "fetched_at": F.lit(asof).cast("timestamp")}
    return out.withColumn("_new", new).select(*[F.when(F.col("_new"), put[c]).otherwise(F.col(c)).alias(c) if c in put else F.col(c) for c in cache.columns])


def stats(cache: DataFrame) -> DataFrame:
    has = lambda c: F.count_if(F.coalesce(c, F.lit("")) != "")
    return cache.agg(F.count(F.lit(1)).alias("n"), has("title").alias("titled"), has("description").alias("blurbed"))


def batches(rows: DataFrame, order: str, size: int = 25) -> DataFrame:
    """Rows with batch and slot numbers in order."""
    out = numbered(rows, [F.col(order)], "_n", first=0)
    return out.withColumn("batch", F.floor(F.col("_n") / size).cast("long")).withColumn("slot", (F.col("_n") % size).cast("long")).drop("_n")


def researched(work: DataFrame, ask: Callable[[list[tuple[str, str]]], dict], workers: int = 3) -> DataFrame:
    """(key, title, description) that ask finds for batches of (key, url), some workers at a time.

    work is what batches() makes of gaps(). A batch that fails gives nothing, and of an answer only dicts with a title that isn't blank count.
    """

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = pd.concat(list(rows) or [pd.DataFrame({"batch": [], "slot": [], "key": [], "url": []})])
        for _, part in whole.sort_values(["batch", "slot"]).groupby("batch"):
            try:
                got = ask(list(zip(part["key"], part["url"], strict=True)))
            except Exception:  # whatever went wrong in one batch, the others count
                got = {}
            good = [(k, v["title"].strip(), v.get("description")) for k, v in (got or {}).items() if isinstance(v, dict) and (v.get("title") or "").strip()]
            yield pd.DataFrame(good, columns=["key", "title", "description"])

    return work.select("batch", "slot", "key", "url").repartition(workers, "batch").mapInPandas(run, "key string, title string, description string")


def fetched(work: DataFrame, fetch: Callable[[str], tuple[str | None, str | None]], asof: str, pause: float = 0.2) -> DataFrame:
    """Cache rows (key, url, ok, title, description, via, error, fetched_at) of work (key, url): fetch gives title and description, an error
    is a row too. Each task waits pause seconds between its links."""

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in rows:
            out = []
            for key, url in zip(part["key"], part["url"], strict=True):
                try:
                    title, description = fetch(url)
                    out.append((key, url, True, title, description, None))
                except Exception as e:  # what a link's server does wrong is a result
                    out.append((key, url, False, None, None, f"{type(e).__name__}: {e}"[:200]))
                time.sleep(pause)
            yield pd.DataFrame(out, columns=["key", "url", "ok", "title", "description", "error"])

    rows = work.select("key", "url").mapInPandas(run, "key string, url string, ok boolean, title string, description string, error string")
    flat = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return rows.select("key", "url", "ok", F.nullif(F.substring(flat(F.col("title")), 1, 160), F.lit("")).alias("title"), html.blurb(flat(F.col("description"))).alias("description"), F.lit(None).cast("string").alias("via"), "error", F.lit(asof).cast("timestamp").alias("fetched_at"))


def upserted(cache: DataFrame, rows: DataFrame) -> DataFrame:
    """The cache with rows in place of its own of the same keys."""
    return cache.join(rows.select("key"), "key", "left_anti").unionByName(rows, allowMissingColumns=True)


def run(work: DataFrame, fetch: Callable, asof: str, state: str, budget: float = 2400.0, slice_rows: int = 500, pause: float = 0.2) -> DataFrame:
    """Fetches work in slices, each written under state once it is done, until all is done or budget seconds have passed; returns what state holds.

    A run that is broken off loses one slice; a rerun goes on with the keys that state doesn't hold. No slice is begun after the budget.
    """
    spark = work.sparkSession
    began = time.monotonic()
    schema = "key string, url string, ok boolean, title string, description string, via string, error string, fetched_at timestamp"

    def held() -> DataFrame:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{state}/slices")
        there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{state}/slices") if there else spark.createDataFrame([], schema)

    left = numbered(work.join(held().select("key"), "key", "left_anti"), [F.col("seq"), F.col("key")], "_n", first=0)
    total = left.count()
    for at in range(0, total, slice_rows):
        if time.monotonic() - began > budget:
            break
        part = left.where(F.col("_n").between(at, at + slice_rows - 1))
        fetched(part, fetch, asof, pause).write.parquet(f"{state}/slices/{uuid.uuid4().hex}")
    return held().dropDuplicates(["key"])
