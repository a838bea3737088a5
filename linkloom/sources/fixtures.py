"""A synthetic harvest for demonstrations: links of an archive shared again weeks before their edition, and links that only the chat has."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import HARVEST

PEOPLE = ["ada", "ben", "chi", "dev"]
CHANNELS = {"900000000000000002": "general", "900000000000000003": "tools", "900000000000000004": "reads"}
GUILD, FIRST_ID = "900000000000000001", 1050000000000000000
#: (url, remark): spellings of one destination, furniture, a discussion.
ONLY_CHAT = [
    ("https://github.com/example/fast", "a fast one"), ("https://github.com/example/fast/", ""), ("https://zed.example/", ""), ("https://bun.example/", "version two is out"),
    ("https://www.youtube.com/watch?v=abc123", ""), ("https://youtu.be/abc123?si=x", "once more"), ("https://db.example/faster.html", "faster than the file system, still"), ("https://en.wikipedia.org/wiki/Cunningham%27s_Law", ""),
    ("https://news.ycombinator.com/item?id=1", "good thread"), ("https://news.ycombinator.com/item?id=2", "another thread"), ("https://term.example/", ""), ("https://www.example.com/engineering/agents", ""),
    ("https://tenor.com/view/x", "lol"), ("https://discord.com/channels/1/2/3", "see above"),
]


def harvest(entries: DataFrame, shared: int = 20, seed: int = 11) -> DataFrame:
    """One row of a harvest document (see files.HARVEST) out of entries (url, title, date).

    shared of them, by the hash of their URL, are shared 3 to 160 days before their date with tracking parameters, videos by their short link; then come
    the links of ONLY_CHAT and one article in the channel of reads. The same entries and seed give the same document.
    """
    spark = entries.sparkSession
    n = lambda mod, *more: F.pmod(F.xxhash64(F.lit(seed), *[F.lit(m) if isinstance(m, str) else m for m in more]), F.lit(mod))
    pick = lambda values, c: F.get(F.array(*map(F.lit, values)), c.cast("int"))
    u = F.col("url")
    rows = entries.where(u.startswith("http") & (F.col("date") != "")).orderBy(F.xxhash64(F.lit(seed), u), u).limit(shared)
    video = F.regexp_extract(u, r"^https?://(?:www\.)?youtube\.com/watch\?v=([\w-]+)", 1)
    short = F.when((video != "") & (n(10, u, "short") < 6), F.concat(F.lit("https://youtu.be/"), video)).otherwise(u)
    link = F.concat(short, F.when(short.contains("?"), "&").otherwise("?"), F.lit("utm_source=chat&utm_medium=share"))
    remark = pick(["", "", "this is neat"], n(4, u, "remark"))
    seen = rows.select(link.alias("url"), F.coalesce(remark, F.concat("title", F.lit(" — worth a look"))).alias("said"), F.date_sub(F.to_date("date"), (n(158, u, "days") + 3).cast("int")).cast("string").alias("day"), F.lit(None).cast("string").alias("ch"))
    alone = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(ONLY_CHAT)], "i int, url string, said string")
    alone = alone.select("url", "said", F.format_string("2026-%02d-%02d", (n(8, F.col("i"), "month") + 1).cast("int"), (n(19, F.col("i"), "day") + 10).cast("int")).alias("day"), F.lit(None).cast("string").alias("ch"))
    reads = spark.createDataFrame([("https://letters.example/2024/review/", "best of the year", "2026-02-14", "900000000000000004")], seen.schema)
    rows = seen.unionByName(alone).unionByName(reads)
    every = F.array_sort(F.collect_list(F.struct("day", "url", F.coalesce("ch", pick(list(CHANNELS), n(3, u, "channel"))).alias("ch"), pick(PEOPLE, n(4, u, "who")).alias("who"), "said")))
    message = lambda m, i: F.struct((F.lit(FIRST_ID) + i * 1000003).cast("string").alias("id"), m["ch"].alias("ch"), F.concat(m["day"], F.lit("T09:14:00.000000+00:00")).alias("ts"), m["who"].alias("author"), m["said"].alias("said"), F.lit(None).cast("string").alias("content"), F.array(F.struct(m["url"].alias("url"), F.lit(None).cast("string").alias("text"))).alias("urls"))
    made = rows.agg(every.alias("m")).withColumn("messages", F.transform("m", message))
    last = F.element_at("messages", -1)["id"]
    meta = F.map_from_arrays(F.array(*map(F.lit, CHANNELS)), F.array(*[F.struct(F.lit(name).alias("name"), F.lit(None).cast("string").alias("parent"), last.alias("lastMessageId"), F.lit(None).cast("boolean").alias("denied")) for name in CHANNELS.values()]))
    empty = F.lit(None).cast("string")
    return made.select(F.lit(GUILD).alias("guildId"), F.lit(True).alias("fixture"), empty.alias("channelId"), empty.alias("lastMessageId"), meta.alias("channels"), F.lit(None).cast("map<string,string>").alias("archiveCursors"), "messages")


def write(document: DataFrame, path: str) -> None:
    """Writes the document as JSON, unless path holds a harvest with messages that isn't a fixture."""
    spark = document.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        held = spark.read.schema(HARVEST).json(path).where("not coalesce(fixture, false) and size(messages) > 0")
        if not held.isEmpty():
            raise ValueError(f"{path} holds a real harvest")
    document.coalesce(1).write.mode("overwrite").json(path)
