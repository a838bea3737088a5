"""The publication: newsletter entries and chat sightings become one archive with ids, facets and figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import archive, sightings as sight
from . import vocabulary as V

#: Numbers of chat sightings come after those of newsletter entries, which the archive's order of sightings needs.
CHAT = 1 << 62
COLUMNS = ["src", "kind", "heading", "title", "description", "clean", "attribution", "marker", "url", "key", "host", "repo", "date", "ed", "ch", "chan", "msg", "msg_url", "by", "id", "seq", "tags"]


@dataclass
class Publication:
    """entries (entry_id, first, last, n, tags, ..), occurrences of what was folded, facets, channels and figures of one build."""

    entries: DataFrame
    occurrences: DataFrame
    facets: DataFrame
    channels: DataFrame
    figures: DataFrame


def tag_names(spark, topics: list[tuple] = V.TOPICS) -> DataFrame:
    """(slug, label, facet) of the fixed tags; of those that several rules give, the last kind of rule names them."""
    rows = {slug: (slug, label, facet) for _, slug, label, facet in topics} | {k: (k, v[0], "kind") for k, v in V.KINDS.items()} | {k: (k, v, "source") for k, v in V.SOURCE_TAGS.items()}
    return spark.createDataFrame(list(rows.values()), "slug string, label string, facet string")


def chat(messages: DataFrame, channels: DataFrame, cache: DataFrame, guild: str | None = None, hidden: tuple[str, ...] = V.HIDDEN_CHANNELS, topics: list[tuple] = V.TOPICS) -> DataFrame:
    """Sightings of COLUMNS out of messages' links (msg, ch, date, author, said, pos, url, text) and channels (ch, name, parent).

    Channels that are hidden, furniture, vacancies and repeats within a message go. A thread goes by its parent's name.
    """
    shown = sight.shown_channels(channels, hidden).withColumn("chan", F.coalesce(F.nullif("parent", F.lit("")), F.nullif("name", F.lit(""))))
    rows = sight.one_per_message(messages.join(F.broadcast(shown.select("ch", "chan")), "ch"), cache=cache)  # a row for each channel
    slugs = sight.channel_slugs(shown.where("chan is not null").select(F.col("chan").alias("name")))
    rows = rows.withColumn("src", F.lit("chat")).withColumn("said", F.regexp_replace(F.coalesce("said", F.lit("")), r"https?://\S+", " "))
    rows = sight.enriched(rows, cache, slugs, guild, topics=topics)
    label = F.create_map(*[F.lit(x) for k, v in V.KINDS.items() for x in (k, v[0])])
    none = F.lit(None).cast("string")
    rows = rows.withColumns({"heading": F.try_element_at(label, F.col("kind")), "by": F.col("author"), "msg": F.col("msg").cast("long"), "id": F.lit(None).cast("long"), "ed": F.lit(None).cast("int"), "clean": none, "attribution": none, "marker": none, "date": F.coalesce("date", F.lit(""))})
    return rows.withColumn("seq", F.lit(CHAT) + F.col("msg") % (1 << 61)).select(*COLUMNS)


def curated(entries: DataFrame) -> DataFrame:
    """newsletter.curated() in the same columns."""
    null = {"ch": "string", "msg": "long", "msg_url": "string", "by": "string"}
    return entries.withColumns({k: F.lit(None).cast(t) for k, t in null.items()}).withColumns({"id": F.col("id").cast("long"), "ed": F.col("ed").cast("int"), "seq": F.col("id").cast("long")}).select(*COLUMNS)


def built(entries: DataFrame, messages: DataFrame, channels: DataFrame, cache: DataFrame, guild: str | None = None, hidden: tuple[str, ...] = V.HIDDEN_CHANNELS, topics: list[tuple] = V.TOPICS) -> Publication:
    """The archive of newsletter entries (what newsletter.curated() makes) and of messages' links, see chat().

    The same inputs give the same rows and ids. Empty inputs give empty tables and figures of 0.
    """
    spark = entries.sparkSession
    rows = curated(entries).unionByName(chat(messages, channels, cache, guild, hidden, topics))
    numbered = archive.with_ids(archive.folded(rows))
    shown = sight.shown_channels(channels, hidden).withColumn("name", F.coalesce(F.nullif("parent", F.lit("")), F.nullif("name", F.lit("")))).where("name is not null").select("name").distinct()
    facets = archive.facet_counts(numbered, tag_names(spark, topics), sight.channel_slugs(shown))
    sources = numbered.agg(F.count_if(F.col("src") == archive.CURATED).alias("newsletter"), F.count_if(F.col("src") != archive.CURATED).alias("chat"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("collapsed"))
    figures = sources.crossJoin(F.broadcast(archive.entities(numbered)))  # one row each
    return Publication(numbered, archive.occurrences(rows, numbered), facets, shown.orderBy("name"), figures)
