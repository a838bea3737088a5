"""Newsletter editions: sections, their kinds and the entries in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import html, text, urls
from ..functions.udfs import content_hash
from ..plans import vocabulary as V
from .ordering import numbered


def edition_number(slug: Column, prefix: str = "edition") -> Column:
    """1 to 100 of 'prefix-N' or of a slug of digits, else null."""
    n = F.coalesce(F.nullif(F.regexp_extract(slug, rf"^{prefix}-(\d+)$", 1), F.lit("")), F.nullif(F.regexp_extract(slug, r"^(\d+)$", 1), F.lit(""))).try_cast("int")
    return F.when(n.between(1, 100), n)


def sections(editions: DataFrame) -> DataFrame:
    """(ed, pos, level, heading, name, content) of editions (ed, body)."""
    rows = editions.select("ed", F.posexplode(html.sections(F.col("body"))).alias("pos", "s")).select("ed", "pos", "s.*")
    return rows.withColumn("name", text.heading(F.col("heading")))


def with_kind(rows: DataFrame, kinds: dict[str, list[str]] | None = None, excluded: list[str] | None = None) -> DataFrame:
    """Sections with the kind that holds at them: known headings set it, excluded ones end it, unknown top-level ones make it awe, others inherit."""
    per = Window.partitionBy("ed")
    known = html.section_kind(F.col("name"), kinds, excluded)
    put = F.coalesce(known, F.when(F.col("level") == F.min("level").over(per), F.lit("awe")))
    so_far = per.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("unknown", known.isNull() & (F.col("level") == F.min("level").over(per)))
    return rows.withColumn("_put", put).withColumn("kind", F.nullif(F.last("_put", ignorenulls=True).over(so_far), F.lit("-"))).drop("_put")


def entries(rows: DataFrame, site: str) -> DataFrame:
    """Entries of sections with kinds: quotes, and the first link of every other unit; news and excluded sections give none."""
    kept = rows.where(F.col("kind").isNotNull() & (F.col("kind") != "news"))
    u = kept.select("ed", "pos", "kind", "heading", F.posexplode(html.units(F.col("content"))).alias("n", "unit"))
    u = u.withColumn("q", html.quotation(F.col("unit"))).withColumn("l", html.first_link(F.col("unit")))
    nothing = F.lit(None).cast("string")
    quotes = u.where("kind = 'quote' and q.quote is not null").select("ed", "pos", "n", "kind", "heading", F.col("q.quote").alias("title"), F.lit("").alias("description"), F.col("q.attribution").alias("attribution"), nothing.alias("url"), nothing.alias("marker"))
    description = F.coalesce(F.nullif(text.tidy(F.col("l.after")), F.lit("")), text.tidy(F.col("l.before")))
    links = u.where("kind <> 'quote' and l.title <> ''").where(F.col("l.url").rlike("^https?://")).select("ed", "pos", "n", "kind", "heading", F.col("l.title").alias("title"), description.alias("description"), nothing.alias("attribution"), F.col("l.url").alias("url"), "l.marker")
    only = F.concat(urls.host(F.col("url")), urls.path(F.col("url"))).rlike("(?i)" + V.newsletter_furniture(site)) & (F.col("description") == "")
    return quotes.unionByName(links.where(~only)).withColumn("heading", text.clean(F.col("heading")))


def curated(rows: DataFrame, published: DataFrame, rewrites: DataFrame | None = None, topics: list[tuple] = V.TOPICS) -> DataFrame:
    """Entries as sightings of the archive: numbered from 1 in the order of editions, with src, date (of published: ed, date), key, host, repo, tags
    and clean, the rewritten description. Quotes have the tag quote and no key."""
    rows = rows if rewrites is None else rewritten(rows, rewrites)
    rows = rows.withColumn("clean", F.lit(None).cast("string")) if rewrites is None else rows.drop("rewrite_key")
    rows = numbered(rows, [F.col("ed"), F.col("pos"), F.col("n")], "id").join(published.select("ed", F.substring("date", 1, 10).alias("date")), "ed", "left")
    link = F.col("url")
    rows = rows.withColumns({"src": F.lit("newsletter"), "date": F.coalesce("date", F.lit("")), "key": urls.canonical_key(link), "host": urls.host(link), "repo": urls.repo(link), "seq": F.col("id"), "chan": F.lit(None).cast("string")})
    tags = html.tags(F.col("kind"), F.col("title"), F.col("description"), F.col("host"), link, F.col("repo"), topics)
    return rows.withColumn("tags", F.when(F.col("kind") == "quote", F.array(F.lit("quote"))).otherwise(tags)).drop("pos", "n")


def rewrite_key(ed: Column, url: Column, title: Column) -> Column:
    return F.concat(ed.cast("string"), F.lit("::"), F.coalesce(url, F.concat(F.lit("q:"), title)))


def to_rewrite(rows: DataFrame) -> DataFrame:
    """(rewrite_key, title, description) of entries that have a description: the list for whoever rewrites them."""
    return rows.where("description <> ''").select(rewrite_key(F.col("ed"), F.col("url"), F.col("title")).alias("rewrite_key"), "title", "description")


def unknown_headings(rows: DataFrame) -> DataFrame:
    """(name, n, editions) of sections with kinds whose top-level heading no rule knows, the most frequent first."""
    return rows.where("unknown").groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("ed")).alias("editions")).orderBy(F.col("n").desc(), "name")


def edition_table(editions: DataFrame, entries: DataFrame, site: str, base: str) -> DataFrame:
    """(ed, slug, title, url, published, refs, n_entries, hash) of editions (ed, slug, title, published, body), in order of their numbers."""
    counts = entries.groupBy("ed").agg(F.count(F.lit(1)).alias("n_entries"))
    rows = editions.join(cross_references(editions, site), "ed").join(counts, "ed", "left")
    return rows.select("ed", "slug", "title", F.concat(F.lit(base.rstrip("/") + "/p/"), "slug").alias("url"), "published", "refs", F.coalesce("n_entries", F.lit(0)).cast("long").alias("n_entries"), content_hash("body").alias("hash")).orderBy("ed")


def cross_references(editions: DataFrame, site: str) -> DataFrame:
    """(ed, refs): sorted distinct numbers of other editions that the body links to."""
    found = F.transform(F.regexp_extract_all("body", F.lit(V.newsletter_link(site)), F.lit(1)), lambda x: x.try_cast("int"))
    return editions.select("ed", F.array_sort(F.array_distinct(F.filter(found, lambda n: n.between(1, 100) & (n != F.col("ed"))))).alias("refs"))


def rewritten(rows: DataFrame, rewrites: DataFrame) -> DataFrame:
    """Entries with clean, the description that rewrites (rewrite_key, clean) have for 'ed::url' or 'ed::q:title'."""
    key = rewrite_key(F.col("ed"), F.col("url"), F.col("title"))
    return rows.withColumn("rewrite_key", key).join(rewrites.where("clean <> ''"), "rewrite_key", "left")
