"""Sources and sinks: harvest documents, rosters, published pages. Schemas are explicit, never inferred."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HARVEST = (
    "guildId STRING, fixture BOOLEAN, channelId STRING, lastMessageId STRING, channels MAP<STRING, STRUCT<name: STRING, parent: STRING, lastMessageId: STRING, denied: BOOLEAN>>, archiveCursors MAP<STRING, STRING>, "
    "messages ARRAY<STRUCT<id: STRING, ch: STRING, ts: STRING, author: STRING, said: STRING, content: STRING, urls: ARRAY<STRUCT<url: STRING, text: STRING>>>>"
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def document(spark: SparkSession, path: str, schema: str, default: list | None = None) -> DataFrame:
    """A JSON document, or rows of default where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(schema).option("multiLine", True).json(path) if there else spark.createDataFrame(default or [], schema)


def archive_cursors(spark: SparkSession, path: str) -> DataFrame:
    """(ch, stamp): up to where the archived threads of each channel were scanned."""
    return document(spark, path, HARVEST).select(F.explode("archiveCursors").alias("ch", "stamp"))


def harvest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(channels, messages) of a harvest document; one of a single channel is read as if it had a channel map. A missing document is empty."""
    doc = document(spark, path, HARVEST)
    old = F.map_from_arrays(F.array("channelId"), F.array(F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("parent"), F.col("lastMessageId"), F.lit(None).cast("boolean").alias("denied"))))
    full = doc.withColumn("channels", F.coalesce("channels", F.when(F.col("channelId").isNotNull(), old)))
    channels = full.select(F.explode("channels").alias("ch", "c")).select("ch", "c.*")
    messages = full.select("guildId", "channelId", F.explode("messages").alias("m")).select("guildId", F.col("m.id").alias("id"), F.coalesce("m.ch", "channelId").alias("ch"), F.col("m.ts").alias("ts"), F.col("m.author").alias("author"), F.coalesce("m.said", "m.content").alias("said"), F.col("m.urls").alias("urls"))
    return channels, messages


def sightings_of(messages: DataFrame) -> DataFrame:
    """(msg, ch, date, pos, url, text): one row for each link of a message."""
    return messages.select(F.col("id").alias("msg"), "ch", F.substring("ts", 1, 10).alias("date"), "author", "said", F.posexplode("urls").alias("pos", "u")).select("msg", "ch", "date", "author", "said", "pos", F.col("u.url").alias("url"), F.col("u.text").alias("text"))


def posts(spark: SparkSession, folder: str, roster: str) -> DataFrame:
    """(post_id, slug, title, published, body) of published posts: files '<id>.<slug>.html' joined to the roster."""
    files = spark.read.text(f"{folder}/*.html", wholetext=True).select(F.element_at(F.split("_metadata.file_name", "/"), -1).alias("f"), F.col("value").alias("body"))
    files = files.select(F.regexp_extract("f", r"^([^.]*)\.", 1).alias("post_id"), F.regexp_extract("f", r"^[^.]*\.(.*)\.html$", 1).alias("slug"), "body")
    rows = spark.read.option("header", True).schema("post_id STRING, is_published STRING, title STRING, post_date STRING").csv(roster)
    return rows.where("is_published = 'true'").withColumn("post_id", F.split_part("post_id", F.lit("."), F.lit(1))).join(files, "post_id").select("post_id", "slug", "title", F.col("post_date").alias("published"), "body")


def embedded(spark: SparkSession, path: str, schema: str, marker: str = "const BOOTSTRAP =") -> DataFrame:
    """The JSON that a page carries in the line that begins with marker."""
    line = spark.read.text(path).where(F.col("value").startswith(marker))
    return line.select(F.from_json(F.regexp_replace(F.trim(F.substring("value", len(marker) + 1, 1 << 30)), ";$", ""), schema).alias("v")).select("v.*")


def publish(df: DataFrame, path: str, order: str | None = None) -> None:
    """Replaces a table as a whole: written beside (in ascending order of a column, by its number, if one is given), the old table is moved
    aside, the new one into its place, and the old one goes. If the last move fails the old table is moved back."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    mark = uuid.uuid4().hex
    if order is not None:
        df = df.orderBy(F.col(order).cast("long"), order)
    df.write.parquet(f"{path}.new-{mark}")
    now, new, old = (jvm.org.apache.hadoop.fs.Path(x) for x in (path, f"{path}.new-{mark}", f"{path}.old-{mark}"))
    fs = now.getFileSystem(conf)
    had = fs.exists(now)
    if had and not fs.rename(now, old):
        raise OSError(f"can't move {path} aside")
    if not fs.rename(new, now):
        if had:
            fs.rename(old, now)
        raise OSError(f"can't move {path}.new-{mark} to {path}")
    if had:
        fs.delete(old, True)


def dump(df: DataFrame, path: str) -> None:
    """A table as JSON lines."""
    df.write.mode("overwrite").json(path)
