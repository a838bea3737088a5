"""The parsing half of host adapters: struct<title, description> out of what a host's interface answers. Nulls where the answer has none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import cut_words, decoded
from .urls import let


def _flat(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " "))


def _pair(title: Column, description: Column) -> Column:
    return F.struct(F.nullif(title, F.lit("")).alias("title"), F.nullif(description, F.lit("")).alias("description"))


def repo(answer: Column, name: Column) -> Column:
    """A project: its full name (else the asked one) and description."""
    return let(F.from_json(answer, "full_name string, description string"), lambda d: _pair(F.coalesce(F.nullif(d["full_name"], F.lit("")), name), d["description"]))


def video(answer: Column) -> Column:
    """A video's oEmbed answer."""
    return let(F.from_json(answer, "title string, author_name string"), lambda d: _pair(d["title"], F.when(d["author_name"] != "", F.concat(F.lit("Video by "), d["author_name"], F.lit(".")))))


def wiki(answer: Column) -> Column:
    return let(F.from_json(answer, "title string, extract string"), lambda d: _pair(d["title"], d["extract"]))


def post(answer: Column) -> Column:
    """A short post: its text, cut at a word's end, with all of it as description; posts without text are named by their author."""

    def of(t: Column) -> Column:
        handle, text = t["author"]["screen_name"], _flat(t["text"])
        who = F.coalesce(F.nullif(t["author"]["name"], F.lit("")), handle, F.lit(""))
        by = F.when(F.coalesce(handle, F.lit("")) != "", F.concat(F.lit("Post by "), who, F.lit(" (@"), handle, F.lit(")"))).otherwise("Post on X")
        title = cut_words(text)
        return F.when(text == "", _pair(by, F.lit(None).cast("string"))).otherwise(_pair(title, F.when(F.length(text) > F.length(title), text).otherwise(by)))

    return let(F.from_json(answer, "tweet struct<text:string,author:struct<name:string,screen_name:string>>")["tweet"], of)


def post_by_path(path: Column) -> Column:
    """What the path alone says of a post that can't be fetched."""
    who = F.regexp_extract(path, r"/([^/]+)/status", 1)
    return _pair(F.when((who != "") & ~who.isin("i", "web"), F.concat(F.lit("Post by @"), who)), F.lit(None).cast("string"))


def paper(answer: Column) -> Column:
    """A paper's Atom feed: the entry's title is the last one, the feed repeats its own before."""
    titles = F.regexp_extract_all(answer, F.lit(r"(?s)<title>(.*?)</title>"), F.lit(1))
    return _pair(decoded(_flat(F.try_element_at(titles, F.lit(-1)))), decoded(_flat(F.regexp_extract(answer, r"(?s)<summary>(.*?)</summary>", 1))))


def stories(asked: DataFrame, items: DataFrame, hops: int = 8) -> DataFrame:
    """(id, story, title, url, text) of asked (id): the item itself or, where it has no title, the first parent that has one, at most hops up.

    items (id, parent, title, url, text) are joined once for each hop, only for what has no title yet.
    """
    named = F.coalesce("title", F.lit("")) != ""
    rows = asked.select("id", F.col("id").alias("story")).distinct()
    held = items.select(F.col("id").alias("_id"), "parent", "title", "url", "text").dropDuplicates(["_id"])
    done = None
    for hop in range(hops + 1):
        met = rows.join(held, F.col("story") == F.col("_id"), "left")
        ends = named | F.col("parent").isNull() | F.lit(hop == hops)
        out = met.where(ends).select("id", "story", "title", "url", "text")
        done = out if done is None else done.unionByName(out)
        rows = met.where(~ends).select("id", F.col("parent").alias("story"))
    return done
