"""Chat harvest: channels that may be read, messages that are new, cursors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls

VIEW = 1 << 10
TEXTUAL, FORUMS, THREADS = (0, 5), (15, 16), (10, 11)


def _public(df: DataFrame, everyone: str) -> DataFrame:
    denied = F.exists(F.coalesce("permission_overwrites", F.array().cast("array<struct<id:string,deny:string>>")), lambda o: (o["id"] == everyone) & (F.coalesce(o["deny"].try_cast("long"), F.lit(0)).bitwiseAND(F.lit(VIEW)) != 0))
    return df.withColumn("open", ~denied)


def visible(channels: DataFrame, threads: DataFrame, everyone: str, excluded: tuple[str, ...] = (), archived: DataFrame | None = None, only: tuple[str, ...] | None = None) -> DataFrame:
    """(id, name, parent): channels that everyone may view, themselves and their category, and the active and archived threads under such channels.

    archived (id, name, parent_id) are threads of any type; excluded ids go, threads too, and only keeps those it names.
    """
    c = _public(channels, everyone)
    up = c.select(F.col("id").alias("_up"), F.col("open").alias("_open"))
    ok = c.join(up, F.col("parent_id") == F.col("_up"), "left").where(F.col("open") & F.coalesce("_open", F.lit(True)) & ~F.col("id").isin(*excluded))
    parents = ok.where(F.col("type").isin(*TEXTUAL, *FORUMS)).select("id", "name", "type")
    own = parents.where(F.col("type").isin(*TEXTUAL)).select("id", "name", F.lit(None).cast("string").alias("parent"))
    under = threads.where(F.col("type").isin(*THREADS)).join(parents.select(F.col("id").alias("parent_id"), F.col("name").alias("parent")), "parent_id").select("id", "name", "parent")
    found = own.unionByName(under)
    if archived is not None:
        found = found.unionByName(archived.join(parents.select(F.col("id").alias("parent_id"), F.col("name").alias("parent")), "parent_id").select("id", "name", "parent"))
    found = found.dropDuplicates(["id"]).where(~F.col("id").isin(*excluded))
    return found if only is None else found.where(F.col("id").isin(*only))


def archived_after(threads: DataFrame, known: DataFrame, since: str | None) -> DataFrame:
    """Archived threads (id, stamp) newer than the cursor; at the cursor itself those not known yet; those without a stamp always."""
    if since is None:
        return threads
    k = known.select(F.col("id").alias("_k")).distinct()
    joined = threads.join(k, F.col("id") == F.col("_k"), "left")
    return joined.where(F.col("stamp").isNull() | (F.col("stamp") > since) | ((F.col("stamp") == since) & F.col("_k").isNull())).drop("_k")


def archive_cursors(old: DataFrame, scanned: DataFrame, failed: DataFrame) -> DataFrame:
    """(ch, stamp): for each parent the newest stamp that its scan saw, or the old one where a thread under it failed or was skipped.

    old (ch, stamp), scanned (parent_id, stamp), failed (parent_id): a parent whose threads weren't all read is scanned again from where it was.
    """
    newest = scanned.groupBy(F.col("parent_id").alias("ch")).agg(F.max("stamp").alias("_new"))
    newest = newest.join(failed.select(F.col("parent_id").alias("ch")).distinct(), "ch", "left_anti")
    return old.join(newest, "ch", "full").select("ch", F.greatest("stamp", "_new").alias("stamp")).where("stamp is not null")


def with_links(messages: DataFrame) -> DataFrame:
    """(id, ch, ts, author, said, urls: array<url, text>) of messages (.., content, embeds) that hold a link: those of the text in order, then those
    of embeds that the text doesn't have. What was said is kept without its links, and cut."""
    own = text.links(F.col("content"))

    def added(have: Column) -> Column:
        fresh = F.filter(F.coalesce("embeds", F.array().cast("array<struct<url:string,title:string>>")), lambda e: (F.coalesce(e["url"], F.lit("")) != "") & ~F.exists(have, lambda h: h["url"] == e["url"]) & ~urls.is_furniture(e["url"]))
        first = F.filter(fresh, lambda e, i: ~F.exists(F.slice(fresh, F.lit(1), i), lambda x: x["url"] == e["url"]))
        return F.concat(F.transform(have, lambda h: F.struct(h["url"].alias("url"), h["text"].alias("text"))), F.transform(first, lambda e: F.struct(e["url"].alias("url"), F.nullif(F.trim(e["title"]), F.lit("")).alias("text"))))

    rows = messages.where("id is not null").withColumn("urls", urls.let(own, added)).where(F.size("urls") > 0)
    return rows.select("id", "ch", "ts", "author", text.commentary(F.col("content")).alias("said"), "urls")


def fresh(messages: DataFrame, known: DataFrame) -> DataFrame:
    """Messages whose id isn't held yet."""
    return messages.dropDuplicates(["id"]).join(known.select("id"), "id", "left_anti")


def cursors(messages: DataFrame) -> DataFrame:
    """(ch, cursor): the largest id seen in each channel, kept or not."""
    return messages.groupBy("ch").agg(F.max(F.col("id").cast("long")).alias("cursor"))


def held(messages: DataFrame, channels: DataFrame) -> DataFrame:
    """(name, n): messages held under each parent or own name, the most first."""
    c = channels.select("ch", F.coalesce("parent", "name").alias("name"))
    return messages.groupBy("ch").agg(F.count(F.lit(1)).alias("n")).join(c, "ch").groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "name")
