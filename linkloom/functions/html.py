"""Newsletter and page markup as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import vocabulary as V
from .text import clean, decoded, tidy
from .udfs import linear, matched
from .urls import let


def meta(page: Column, *names: str) -> Column:
    """The first <meta> of these names that isn't blank, whichever attribute comes first."""

    def found(low: Column) -> Column:
        # a page that lacks the name isn't searched for its pattern
        return F.coalesce(*[F.when(low.contains(name.lower()), F.nullif(F.trim(F.regexp_extract(page, p.replace("{name}", name), 1)), F.lit(""))) for name in names for p in (V.META_FIRST, V.META_LAST)])

    return F.trim(decoded(let(F.lower(page), found)))


def scraped(page: Column) -> Column:
    """struct<title, description> of a page as the cache keeps them; nulls if it isn't HTML."""
    title = F.coalesce(meta(page, "og:title", "twitter:title"), F.nullif(decoded(F.regexp_extract(page, V.TITLE, 1)), F.lit("")))
    flat = lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))
    description = F.coalesce(flat(meta(page, "og:description", "twitter:description", "description")), F.lit(""))
    is_html = F.lower(F.substring(page, 1, 2000)).contains("<html")
    parts = let(description, lambda d: F.struct(F.substring(flat(title), 1, 160).alias("title"), blurb(d).alias("description")))
    return F.when(is_html, parts).otherwise(F.struct(F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("description")))


def blurb(description: Column, boilerplate: str = V.BOILERPLATE) -> Column:
    """A cached description: no boilerplate, cut, tidied; null instead of empty."""
    kept = F.when(F.substring(description, 1, 200).rlike("(?i)" + boilerplate), "").otherwise(description)
    return F.nullif(tidy(F.substring(kept, 1, 400)), F.lit(""))


def sections(body: Column) -> Column:
    """array<struct<level, heading, content>> in order: what stands from a heading to the next one; text before the first is left out."""
    parts = F.slice(F.split(body, r"(?s)(?=<h[1-6][^>]*>.*?</h[1-6]>)"), F.lit(1), F.lit(1 << 30))
    whole = F.filter(parts, lambda x: x.rlike(r"(?s)^<h([1-6])[^>]*>.*?</h\1>"))
    of = lambda x, n: F.regexp_extract(x, r"(?s)^<h([1-6])[^>]*>(.*?)</h\1>(.*)$", n)
    return F.transform(whole, lambda x: F.struct(of(x, 1).cast("int").alias("level"), of(x, 2).alias("heading"), of(x, 3).alias("content")))


def units(content: Column) -> Column:
    """Inner markup of list items and quotes in order; a nested list ends its item."""
    found = F.regexp_extract_all(content, F.lit(V.UNIT), F.lit(0))
    return F.transform(found, lambda x: F.regexp_replace(x, r"(?s)^<(?:li|blockquote)[^>]*>|</(?:li|blockquote)>$", ""))


def first_link(unit: Column) -> Column:
    """struct<url, title, before, after, marker>: the first strong link, else the first link, the text around, and the pictures before it."""
    cut = lambda pattern: F.array(*[F.regexp_extract(unit, pattern, n) for n in (1, 2, 3, 4)])
    parts = F.when(unit.rlike(V.STRONG_LINK), cut(V.STRONG_LINK)).when(unit.rlike(V.PLAIN_LINK), cut(V.PLAIN_LINK))

    def made(x: Column) -> Column:
        sign = let(x["lead"], lambda lead: marker(F.when(lead != "", lead).otherwise(clean(unit))))

        def after(y: Column) -> Column:
            bare = F.when(y["sign"].isNotNull() & y["lead"].startswith(y["sign"]), F.substring(y["lead"], F.length(y["sign"]) + 1, F.length(y["lead"]))).otherwise(y["lead"])
            before = F.trim(F.regexp_replace(bare, r"[\s\[\(<–—:-]+$", ""))
            return F.struct(F.trim(decoded(F.get(x["p"], F.lit(1)))).alias("url"), clean(F.get(x["p"], F.lit(2))).alias("title"), before.alias("before"), clean(F.get(x["p"], F.lit(3))).alias("after"), y["sign"].alias("marker"))

        return let(F.struct(x["lead"].alias("lead"), sign.alias("sign")), after)

    return let(parts, lambda p: let(F.struct(p.alias("p"), clean(F.get(p, F.lit(0))).alias("lead")), made))


def marker(text: Column) -> Column:
    """The run of pictures that a text begins with, else null."""
    return F.nullif(F.regexp_replace(F.regexp_extract(text, V.MARKER, 1), r"^[\x{200D}\x{FE0F} ]+|[\x{200D}\x{FE0F} ]+$", ""), F.lit(""))


def quotation(unit: Column) -> Column:
    """struct<quote, attribution>: the last line if it begins with a dash, else what follows a spaced dash."""

    def of(lines: Column) -> Column:
        last = F.try_element_at(lines, F.lit(-1))
        dashed = F.coalesce((F.size(lines) >= 2) & last.rlike(rf"^\s*[{V.QUOTE_DASH}]"), F.lit(False))
        body = F.array_join(F.when(dashed, F.slice(lines, F.lit(1), F.greatest(F.size(lines) - 1, F.lit(0)))).otherwise(lines), " ")
        parts = F.struct(dashed.alias("dashed"), body.alias("body"), F.split(body, V.QUOTE_CUT, 2).alias("cut"), F.trim(F.regexp_replace(last, rf"^[\s{V.QUOTE_DASH}]+", "")).alias("by"))

        def made(x: Column) -> Column:
            said = F.when(x["dashed"], x["body"]).otherwise(F.get(x["cut"], F.lit(0)))
            by = F.when(x["dashed"], x["by"]).otherwise(F.trim(F.get(x["cut"], F.lit(1))))
            quotes = F.lit('"“”')
            return F.struct(F.nullif(F.btrim(F.trim(F.regexp_replace(said, V.MARKER, "")), quotes), F.lit("")).alias("quote"), F.nullif(F.btrim(by, quotes), F.lit("")).alias("attribution"))

        return let(parts, made)

    return let(F.filter(F.transform(F.split(unit, r"<br\s*/?>"), clean), lambda x: x != ""), of)


def tags(kind: Column, title: Column, description: Column, host: Column, url: Column, repo: Column, topics: list[tuple] = V.TOPICS) -> Column:
    """Ordered tags: kind, topics, then what host and text add. topics are (pattern, slug, label, facet)."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    text = F.lower(F.concat_ws(" ", empty(title), empty(description), empty(host), empty(url)))
    patterns = [*[pattern for pattern, *_ in topics], V.VIDEO_WORD]

    def of(found: list[Column]) -> Column:
        named = [F.when(f, slug) for f, (_, slug, *_) in zip(found, topics)]
        video = empty(host).rlike(V.VIDEO_HOST) | found[-1]
        more = [F.when(repo.isNotNull(), "opensource"), F.when(empty(host).endswith("wikipedia.org"), "wikipedia"), F.when(video, "video")]
        return F.array_except(F.array(kind, *named, *more), F.array(F.lit(None).cast("string")))

    if linear(patterns):
        bits = matched(text, patterns)
        return of([bits.bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(patterns))])
    # letters of any language bound a word
    return let(text, lambda hay: of([hay.rlike("(?U)" + p) for p in patterns]))


def kind_for(channel: Column, host: Column, channels: list[tuple[str, str]] = V.CHANNEL_KINDS, read: str = V.READ_HOST) -> Column:
    """Kind of a chat link: the channel's name decides before the host does."""
    by_name = [F.when(F.coalesce(channel, F.lit("")).rlike("(?i)" + pattern), kind) for pattern, kind in channels]
    by_host = F.when(F.coalesce(host, F.lit("")).rlike("(?i)" + read), "read").otherwise("tool")
    return F.coalesce(*by_name, by_host)


def section_kind(name: Column, sections: dict[str, list[str]] | None = None, excluded: list[str] | None = None) -> Column:
    """Kind of a normalised heading, '-' of an excluded one, null of an unknown one."""
    sections = V.SECTIONS if sections is None else sections
    return reduce(lambda c, k: c.when(name.isin(*sections[k]), k), sections, F.when(name.isin(*(V.EXCLUDED_SECTIONS if excluded is None else excluded)), "-"))
