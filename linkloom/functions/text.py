"""Text as Column expressions: tidying, commentary, headings, markup."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans import vocabulary as V
from .urls import capital, is_furniture, let

#: The references of HTML 4 by name; those that HTML 5 adds are for `unescaped` in functions.udfs, which decodes all.
REFERENCES = {**name2codepoint, "apos": 39}
_NAMES = json.dumps(REFERENCES)
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&"


def tidy(text: Column) -> Column:
    """A description without leading punctuation and connective, capitalised, with a stop; null becomes empty."""
    lead = F.regexp_replace(F.coalesce(text, F.lit("")), V.LEAD, "")
    rest = F.regexp_replace(F.regexp_replace(lead, V.CONNECTIVE, ""), r"^\s+|\s+$", "")

    def ended(r: Column) -> Column:
        said = capital(r)
        return F.when(r == "", "").when(F.substring(r, -1, 1).isin(*V.STOPS), said).otherwise(F.concat(said, F.lit(".")))

    return let(rest, ended)


def commentary(text: Column, most: int = 300) -> Column:
    """What was said around links, cut to most code points."""

    def said(x: Column) -> Column:
        flat = F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"https?://\S+", " "), r"\s+", " ")
        return F.btrim(flat, F.lit(" -–—:•|"))

    # where the beginning of a long text gives more than is kept, the rest changes nothing: its end may hold part of a link, at most 8 code points
    begun = said(F.substring(text, 1, 4 * most))
    enough = (F.length(text) > 4 * most) & (F.length(begun) >= most + 20)
    return F.substring(F.when(enough, begun).otherwise(said(text)), 1, most)


def links(text: Column) -> Column:
    """array<struct<url, text>>: the distinct links in order, furniture dropped; text is the last markdown label of exactly that url."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(V.BARE_URL), F.lit(0)), lambda u: F.regexp_replace(u, ">+$", "")))
    marked = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(V.MARKED_LINK), F.lit(0))
    label = lambda u: F.try_element_at(F.filter(marked, lambda m: F.regexp_extract(m, r"\]\((https?://[^\s)]+)\)$", 1) == u), F.lit(-1))
    return F.transform(F.filter(found, lambda u: ~is_furniture(u)), lambda u: F.struct(u.alias("url"), F.trim(F.regexp_extract(label(u), r"^\[([^\]]{1,200})\]", 1)).alias("text")))


def decoded(text: Column) -> Column:
    """The text with numbered references and those of HTML 4 decoded, each once; unknown ones stay."""
    names = F.from_json(F.lit(_NAMES), "map<string,int>")  # a constant

    def one(part: Column) -> Column:
        name = F.substring(part, F.lit(2), F.length(part) - 2)
        number = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, F.lit(3), F.lit(8)), 16, 10)).when(name.startswith("#"), F.substring(name, F.lit(2), F.lit(8))).cast("long")
        valid = lambda c: c.between(1, 0x10FFFF) & ~c.between(0xD800, 0xDFFF)
        sign = let(F.coalesce(number, F.try_element_at(names, name).cast("long")), lambda c: F.when(valid(c), F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32")))
        return F.when(part.startswith("&") & (F.length(part) > 2), F.coalesce(sign, part)).otherwise(part)

    return let(text, lambda t: F.when(t.contains("&"), F.array_join(F.transform(F.regexp_extract_all(t, F.lit(_REFERENCE), F.lit(0)), one), "")).otherwise(t))


def clean(markup: Column) -> Column:
    """Text of a fragment: no tags, references decoded, no joiners, trimmed."""
    return F.regexp_replace(F.replace(decoded(F.regexp_replace(markup, "<[^>]+>", "")), F.lit("‍"), F.lit("")), r"^\s+|\s+$", "")


def heading(markup: Column) -> Column:
    """A heading as sections are looked up by it."""
    low = F.regexp_replace(F.lower(decoded(F.regexp_replace(markup, "<[^>]+>", ""))), "['’()]", "")
    return F.trim(F.regexp_replace(low, "[^a-z0-9]+", " "))


def cut_words(text: Column, most: int = 110) -> Column:
    """At most so many code points, at a word's end, with an ellipsis if something went."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.rtrim(F.regexp_replace(F.substring(text, 1, most), r"\s\S*\z", "")), F.lit("…")))


def corpus_text(title: Column, description: Column) -> Column:
    return F.substring(F.concat(title, F.lit(". "), F.coalesce(description, F.lit(""))), 1, 400)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
