"""The archive: one row for each destination, with its first and last sighting, facets and traces."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import numbered

#: The curated source, whose copy of a destination wins.
CURATED = "newsletter"
#: What a sighting hands on to the archive, and what it leaves when another one stands for its key.
ENTRY = ["url", "src", "date", "id", "seq", "title", "description", "kind", "tags", "chan"]
MORE = ["host", "repo", "ed", "msg", "by", "msg_url", "heading", "attribution", "marker", "clean"]
OCCURRENCE = ["src", "date", "ed", "chan", "msg_url", "by"]


def _order() -> list[Column]:
    return [F.coalesce("date", F.lit("")), F.coalesce("id", F.lit(0)), F.col("seq")]


def _rank(rows: DataFrame) -> Column:
    """The least of these is the sighting that stands for its key: curated, longer description, real title, then the earliest."""
    said = F.coalesce("clean", "description", F.lit("")) if "clean" in rows.columns else F.coalesce("description", F.lit(""))
    title = F.coalesce("title", F.lit(""))
    return F.struct((F.col("src") != CURATED).alias("a"), (-F.length(said)).alias("b"), ((title == "") | title.startswith("http")).alias("c"), *[c.alias(f"d{i}") for i, c in enumerate(_order())])


def folded(sightings: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row a key: the surviving sighting, n, key_seq, first and last, and the union of tags.

    Everything is a partial aggregate over one pass, so that a link that is everywhere is no hot key: the survivor is the least by a total order
    (seq is unique). Sightings are folded for each list of tags first, then the lists of a key are joined in the order in which they come first, the
    survivor's own before all; a key has as many lists as its kinds, topics, sources and channels combine. Sightings without a key stay single.
    What did not survive is in occurrences(). Of the survivor only columns are kept, if they are named: what else it has isn't worked out.
    """
    have = [c for c in [*ENTRY, *MORE] if c in sightings.columns and (columns is None or c in columns)]
    tagged = "tags" in have
    own = [c for c in have if c != "tags"]
    rows = sightings.where("key is not null")
    real = F.when(F.col("date") != "", F.col("date"))
    best = [F.min(F.struct(_rank(rows).alias("rank"), F.struct(*own, F.lit(0).alias("_")).alias("own"))).alias("best")] if have else []
    of = [*best, F.count(F.lit(1)).alias("n"), F.min(real).alias("lo"), F.max(real).alias("hi"), F.min("date").alias("any"), F.min("seq").alias("key_seq")]
    if tagged:
        lists = rows.withColumn("_tags", F.coalesce("tags", F.array().cast("array<string>"))).groupBy("key", "_tags").agg(*of, F.min(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_order())])).alias("place"))
        least = F.min(F.struct("best.rank", "best.own", F.col("_tags").alias("tags"))).alias("best")
        by = lists.groupBy("key").agg(least, F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("any").alias("any"), F.min("key_seq").alias("key_seq"), F.array_sort(F.collect_list(F.struct("place", "_tags"))).alias("all"))
        tags = [F.array_distinct(F.concat("best.tags", F.flatten(F.transform("all", lambda x: x["_tags"])))).alias("tags")]
    else:
        by, tags = rows.groupBy("key").agg(*of), []
    many = F.col("n") > 1
    out = by.select("key", *[F.col(f"best.own.{c}").alias(c) for c in own], "n", "key_seq", F.when(many, F.col("lo")).otherwise(F.col("any")).alias("first"), F.when(many, F.col("hi")).otherwise(F.col("any")).alias("last"), *tags)
    single = sightings.where("key is null").withColumns({"n": F.lit(1).cast("long"), "key_seq": F.col("seq"), "first": F.col("date"), "last": F.col("date")})
    return out.unionByName(single.select([c for c in out.columns if c in single.columns]), allowMissingColumns=True)


def occurrences(sightings: DataFrame, archive: DataFrame) -> DataFrame:
    """(key, seq, id, and of src, date, ed, chan, msg_url, by what there is): the sightings of each key that another one stands for.

    A table of its own, in which a destination that is everywhere takes many rows and no row grows; its order is (date, id, seq).
    """
    have = [c for c in OCCURRENCE if c in sightings.columns]
    best = archive.where("n > 1").select(F.col("key").alias("_key"), F.col("seq").alias("_seq"))
    rows = sightings.where("key is not null").select("key", "seq", "id", *have)
    return rows.join(best, (F.col("key") == F.col("_key")) & (F.col("seq") != F.col("_seq"))).drop("_key", "_seq")


def with_also(archive: DataFrame, others: DataFrame) -> DataFrame:
    """The archive with also, the occurrences of each row nested in order: the shape of the published page."""
    have = [c for c in OCCURRENCE if c in others.columns]
    nested = others.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_order())], F.struct(*have).alias("o")))).alias("all"))
    return archive.join(nested.select(F.col("key").alias("_key"), F.transform("all", lambda x: x["o"]).alias("also")), F.col("key") == F.col("_key"), "left").drop("_key")


def with_ids(rows: DataFrame) -> DataFrame:
    """Rows with entry_id, the dense id (from 1) of the published order: curated ones by their old id, then the rest by message; ties by key_seq."""
    at = F.when(F.col("src") == CURATED, F.coalesce("id", F.lit(0))).otherwise(F.coalesce("msg", "id", F.lit(0)) if "msg" in rows.columns else F.coalesce("id", F.lit(0)))
    return numbered(rows, [F.when(F.col("src") == CURATED, 0).otherwise(1), at.cast("long"), F.col("key_seq")], "entry_id")


def titled(slug: Column) -> Column:
    """A slug in title case: every run of letters begins with a capital."""
    return F.array_join(F.transform(F.regexp_extract_all(slug, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0)), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, F.lit(2), F.length(x))))), "")


def facet_counts(rows: DataFrame, meta: DataFrame, channels: DataFrame | None = None) -> DataFrame:
    """(slug, label, facet, n) of tags, the most frequent first, then by slug.

    meta (slug, label, facet) names them, channels (name, slug) those that meta doesn't; others are topics in title case.
    """
    names = meta.select("slug", "label", "facet", F.lit(0).alias("_rank"))
    if channels is not None:
        names = names.unionByName(channels.select("slug", F.concat(F.lit("#"), "name").alias("label"), F.lit("channel").alias("facet"), F.lit(1).alias("_rank")))
    names = names.groupBy("slug").agg(F.min_by(F.struct("label", "facet"), F.struct("_rank", "label")).alias("m")).select("slug", "m.label", "m.facet")
    counts = rows.select(F.explode("tags").alias("slug")).groupBy("slug").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(names, "slug", "left").select("slug", F.coalesce("label", titled(F.col("slug"))).alias("label"), F.coalesce("facet", F.lit("topic")).alias("facet"), "n").orderBy(F.col("n").desc(), "slug")


def per_channel(rows: DataFrame) -> DataFrame:
    """(chan, n, place): shown entries of each channel, the most first; ties by where the channel comes first."""
    by = rows.where(F.col("src") != CURATED).groupBy("chan").agg(F.count(F.lit(1)).alias("n"), F.min("key_seq").alias("_first"))
    return numbered(by, [F.col("n").desc(), F.col("_first")], "place").drop("_first")


def entities(rows: DataFrame) -> DataFrame:
    """(entities): distinct destinations; what has none counts by its title."""
    return rows.agg(F.count_distinct(F.coalesce("key", F.concat(F.lit("quote::"), "title"))).alias("entities"))


def within(rows: DataFrame, asof: str, days: int) -> DataFrame:
    """Entries whose most recent sighting is at most so many days before asof."""
    return rows.where(F.to_date("last") >= F.date_sub(F.lit(asof).cast("date"), days))


def with_tag(rows: DataFrame, *slugs: str) -> DataFrame:
    return rows.where(F.array_contains("tags", slugs[0]) if len(slugs) == 1 else F.size(F.array_except(F.array(*map(F.lit, slugs)), "tags")) == 0)


def trace(rows: DataFrame) -> DataFrame:
    """First and last sighting of any set of entries, and which entries they were."""
    lo, hi = F.struct("first", "key"), F.struct("last", "key")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min(lo).alias("a"), F.max(hi).alias("b")).select("n", F.col("a.first").alias("first_seen"), F.col("a.key").alias("first_key"), F.col("b.last").alias("last_seen"), F.col("b.key").alias("last_key"))


def frame(text: Column) -> Column:
    """Length in eight bytes and the bytes: what a fingerprint takes of one text."""
    return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(text)), 16, "0")), F.encode(text, "UTF-8"))


def fingerprint(rows: DataFrame, text: str, order: str) -> DataFrame:
    """(digest, n): SHA-256 over the framed texts in order.

    The digest is sequential by definition, so one task reads all frames; it streams them from a sort that spills and holds one batch at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, n = hashlib.sha256(), 0
        for batch in batches:
            for x in batch.column("f"):
                digest.update(x.as_buffer() or b"")
            n += len(batch)
        yield pa.RecordBatch.from_pydict({"digest": [digest.hexdigest()], "n": pa.array([n], pa.int64())})

    return rows.select(F.col(order).alias("o"), frame(F.coalesce(F.col(text), F.lit(""))).alias("f")).repartition(1).sortWithinPartitions("o", "f").mapInArrow(run, "digest string, n long")


def unchanged(old: DataFrame, new: DataFrame) -> bool:
    """Whether two published tables hold the same rows: then the old stamp stays."""
    return old.exceptAll(new).isEmpty() and new.exceptAll(old).isEmpty()


def vectors_stale(meta: dict, rows: int, dim: int, digest: str, size: int) -> bool:
    """Whether stored vectors don't belong to this corpus."""
    return size != rows * dim * 4 or meta != {"hash": digest, "rows": rows, "dim": dim}
