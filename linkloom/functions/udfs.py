"""What Spark has no function for: BLAKE2b digests, all of HTML's character references, and many patterns in linear time. Arrow batches."""

from __future__ import annotations

import hashlib
import html

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType


@F.pandas_udf(StringType())
def content_hash(bodies: pd.Series) -> pd.Series:
    """16 hex digits of the 64-bit BLAKE2b digest of a body; null of null."""
    return bodies.map(lambda b: None if b is None else hashlib.blake2b(b.encode(), digest_size=8).hexdigest())


@F.pandas_udf(StringType())
def unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else html.unescape(t))


def linear(patterns: list[str]) -> bool:
    """Whether all patterns are ones that run in linear time (no looking around, no references), and few enough for matched()."""
    try:
        return len(patterns) < 63 and all(pc.match_substring_regex(pa.array([""]), p) is not None for p in patterns)
    except pa.ArrowInvalid:
        return False


def matched(text: Column, patterns: list[str]) -> Column:
    """A number with bit i set where patterns[i] is found; letters of any language bound a word. No backtracking: the time of a pattern grows with
    the text alone."""

    def bits(texts: pa.Array) -> pa.Array:
        # letters beyond ASCII are made Latin ones, since a word's bound knows no others
        plain = pc.replace_substring_regex(texts, r"[^\x00-\x7F\P{L}]", "z")
        found = pa.array([0] * len(texts), pa.int64())
        for i, p in enumerate(patterns):
            found = pc.bit_wise_or(found, pc.shift_left(pc.match_substring_regex(plain, p).cast(pa.int64()), i))
        return found

    return F.arrow_udf(bits, LongType())(text)
