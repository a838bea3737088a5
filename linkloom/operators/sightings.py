"""Sightings: links in messages and editions, filtered, named and described."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html, text, urls
from ..plans import vocabulary as V

#: What linked() adds to sightings.
LINKED = ("key", "host", "repo", "named", "idle", "cached", "blurb")


def shown_channels(channels: DataFrame, hidden: tuple[str, ...] = V.HIDDEN_CHANNELS) -> DataFrame:
    """Channels (ch, name, parent) whose parent or own name isn't hidden."""
    name = F.regexp_replace(F.coalesce(F.nullif("parent", F.lit("")), "name", F.lit("")), "^#+", "")
    return channels.where(~name.isin(*hidden))


def channel_slugs(names: DataFrame, column: str = "name") -> DataFrame:
    """(name, slug) of distinct channel names; a slug that is a tag of its own gets a prefix, empty ones go."""
    slug = F.btrim(F.regexp_replace(F.lower(F.trim(column)), "[^a-z0-9]+", "-"), F.lit("-"))
    known = [*(t[1] for t in V.TOPICS), *V.KINDS, *V.SOURCE_TAGS]
    return names.select(F.trim(column).alias("name"), F.when(slug.isin(*known), F.concat(F.lit("ch-"), slug)).otherwise(slug).alias("slug")).where("slug <> ''").dropDuplicates(["name"])


def linked(rows: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """Rows (url, ..) with what depends on the link alone: key, host, repo, named, idle (furniture or a vacancy) and, of a cache (key, title,
    description), cached and blurb. It is worked out once for each URL, and joined by it."""
    u = F.col("_url")
    links = rows.select(F.col("url").alias("_url")).distinct()
    links = links.select("_url", urls.canonical_key(u).alias("key"), urls.host(u).alias("host"), urls.repo(u).alias("repo"), urls.name_from_url(u).alias("named"), (urls.is_furniture(u) | urls.is_job(u)).alias("idle"))
    if cache is not None:
        c = cache.select(F.col("key").alias("_key"), F.trim("title").alias("cached"), F.col("description").alias("blurb"))
        links = links.join(c, F.col("key") == F.col("_key"), "left").drop("_key")
    # the table of links is hashed, so that sightings with their texts aren't sorted
    return rows.drop(*LINKED).join(links.hint("shuffle_hash"), F.col("url").eqNullSafe(u)).drop("_url")


def one_per_message(rows: DataFrame, message: str = "msg", position: str = "pos", cache: DataFrame | None = None) -> DataFrame:
    """The first link of each destination in a message, as linked() makes them; furniture, vacancies and links without a key are left out first."""
    rows = linked(rows, cache).where("not idle and key is not null")
    w = Window.partitionBy(message, "key").orderBy(position)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def title_of(said: Column, cached: Column, name: Column) -> Column:
    """Link text, cached title or the URL's name; what looks like a URL is no title. Cut to 200."""
    named = lambda c: F.when((F.coalesce(c, F.lit("")) != "") & ~c.rlike("^https?://"), c)
    return F.substring(F.coalesce(named(said), named(cached), name), 1, 200)


def description_of(remark: Column, cached: Column) -> Column:
    """A long remark, else the cached blurb, else a shorter remark, else nothing. Cut to 500."""
    tidied = text.tidy(remark)
    return F.substring(F.when(F.length(tidied) >= 40, tidied).when(F.coalesce(cached, F.lit("")) != "", cached).when(F.length(tidied) >= 20, tidied).otherwise(""), 1, 500)


def permalink(guild: Column, channel: Column, message: Column, base: str = "https://discord.com/channels") -> Column:
    return F.when(guild.isNotNull() & channel.isNotNull(), F.concat_ws("/", F.lit(base), guild, channel, message))


def enriched(sightings: DataFrame, cache: DataFrame, slugs: DataFrame | None = None, guild: str | None = None, source: str = "discord", topics: list[tuple] = V.TOPICS) -> DataFrame:
    """Sightings (url, chan, and if they have them text, said, ch, msg) with key, host, repo, title, description, kind, tags and msg_url.

    cache (key, title, description) is joined on the key, slugs (name, slug) on the channel's name. A title is the link's text, the cached one or
    the URL's name; a description a long remark, the cached one or a short remark. Tags of chat sightings end with source and channel.
    What depends on the link alone is worked out once for each URL; sightings that linked() made with a cache have it already.
    """
    rows = sightings if {"cached", "named"} <= set(sightings.columns) else linked(sightings, cache)
    nothing = F.lit(None).cast("string")
    said, shown = (F.col(c) if c in sightings.columns else nothing for c in ("said", "text"))
    made = ["key", "host", "repo", "title", "description", "kind", "tags"]
    rows = rows.drop("title", "description", "kind", "tags")
    slug = nothing
    if slugs is not None:  # a row for each channel
        rows = rows.join(F.broadcast(slugs.select(F.col("name").alias("_name"), F.col("slug").alias("_slug"))), F.col("chan") == F.col("_name"), "left")
        slug = F.col("_slug")
    rows = rows.withColumns({"title": title_of(F.trim(shown), F.col("cached"), F.col("named")), "description": description_of(said, F.col("blurb")), "kind": html.kind_for(F.col("chan"), F.col("host"))})
    tags = html.tags(F.col("kind"), F.col("title"), F.col("description"), F.col("host"), F.col("url"), F.col("repo"), topics)
    chat = F.concat(tags, F.array_except(F.array(F.lit(source), slug), F.array(nothing)))
    rows = rows.withColumn("tags", F.when(F.col("src") == "newsletter", tags).otherwise(chat) if "src" in sightings.columns else chat)
    out = rows.select(*[c for c in sightings.columns if c not in (*LINKED, *made)], *made)
    if {"ch", "msg"} <= set(sightings.columns) and "msg_url" not in sightings.columns:
        out = out.withColumn("msg_url", permalink(F.lit(guild).cast("string"), F.col("ch").cast("string"), F.col("msg").cast("string")))
    return out
