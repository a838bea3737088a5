"""Benchmark decontamination: SimHash fingerprints of item-sized windows, found by multi-index Hamming blocks, confirmed exactly. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import let, table, written

#: Words of a shingle, least weighted similarity of window and item, bits of a fingerprint, and its largest Hamming distance.
#: At a similarity of 0.8 the mean distance is 9.7 bits and its deviation 2.9; all pairs within RADIUS are found.
WORDS, SIMILAR, BITS, RADIUS = 5, 0.8, 64, 21
#: Words of a benchmark that is broadcast, its shingles taking about 40 bytes each; a larger one is shuffled.
BLOCK = 200_000
#: What rounding may take from a product of a similarity and a weight.
SLACK = 1e-6


def words(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _shingles(w: Column, k: int) -> Column:
    """Hash of each k-word shingle; no shingle if there are fewer words. w: hashes of the words."""
    parts = lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)])
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), parts)).otherwise(F.array().cast("array<bigint>"))


def _weights(lengths: Column, k: int) -> Column:
    """Weight of each shingle: its letters. Long words say more than short ones."""
    parts = lambda i: reduce(lambda a, b: a + b, [F.get(lengths, i + j) for j in range(k)])
    return F.when(F.size(lengths) >= k, F.transform(F.sequence(F.lit(0), F.size(lengths) - k), parts)).otherwise(F.array().cast("array<int>"))


def simhash(pairs: Column) -> Column:
    """64 bits of the sign of the weighted sum of the bits of hashes; pairs: array of (h, w)."""

    def bit(b: int) -> Column:
        vote = F.aggregate(pairs, F.lit(0), lambda s, p: s + F.when(F.shiftright(p["h"], b).bitwiseAND(F.lit(1)) == 1, p["w"]).otherwise(-p["w"]))
        return F.when(vote > 0, F.lit(1 << b if b < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))

    return reduce(lambda a, b: a.bitwiseOR(b), [bit(b) for b in range(BITS)])


def _blocks(fp: Column, radius: int) -> Column:
    """radius + 1 parts (n, bits) of a fingerprint: two within radius share at least one."""
    n = radius + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return F.array(*[F.struct(F.lit(i).alias("n"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits")) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))])


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda s, p: s + p["n"] * p["w"])


def similarity(a: Column, b: Column) -> Column:
    """Weighted resemblance of two bags, maps from a shingle's hash to (n, w): sum of least counts by weight over sum of greatest."""
    both = F.aggregate(
        F.map_entries(a), F.lit(0).cast("long"),
        lambda s, e: s + F.least(e["value"]["n"], F.coalesce(F.try_element_at(b, e["key"])["n"], F.lit(0))) * e["value"]["w"],
    )
    whole = _total(F.map_values(a)) + _total(F.map_values(b)) - both
    return F.when(whole > 0, both / whole).otherwise(F.lit(0.0))


def _bag(pairs: Column) -> Column:
    keys = F.array_distinct(F.transform(pairs, lambda p: p["h"]))
    one = lambda k: F.struct(F.size(F.filter(pairs, lambda p: p["h"] == k)).cast("long").alias("n"), F.filter(pairs, lambda p: p["h"] == k)[0]["w"].cast("long").alias("w"))
    return F.map_from_arrays(keys, F.transform(keys, one))


def _hashed(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _pairs(w: Column, k: int) -> Column:
    """(h, w) of each shingle of an array of words."""
    hashes = let(_hashed(w), lambda h: _shingles(h, k))
    weights = let(F.transform(w, lambda x: F.length(x)), lambda n: _weights(n, k))
    return F.arrays_zip(hashes.alias("h"), weights.alias("w"))


def items_of(benchmark: DataFrame, k: int | None, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, m, pairs) of items with a word: of at least WORDS words (k None) or of k words."""
    w = benchmark.select(F.col(key).alias("item_id"), words(F.col(text)).alias("_w")).where("item_id is not null").where(F.size("_w") >= WORDS if k is None else F.size("_w") == k).dropDuplicates(["item_id", "_w"])
    return w.select("item_id", F.size("_w").alias("m"), _pairs(F.col("_w"), k or WORDS).alias("pairs"))


def _held(df: DataFrame, small: bool) -> DataFrame:
    """df for a join: broadcast where its size is known to be small, else left to be shuffled."""
    return F.broadcast(df) if small else df


def _candidates(docs: DataFrame, items: DataFrame, k: int, similar: float, small: bool) -> DataFrame:
    """(doc_id, version, item_id, m, all, places): documents whose shingles that an item has too (at places pos, of weight w, ascending) weigh as much as a match needs."""
    shingles = items.select("item_id", "m", F.explode("pairs").alias("p")).select("item_id", "m", F.col("p.h").alias("h"), F.col("p.w").alias("w")).distinct()
    rows = docs.select("doc_id", "version", F.posexplode(let(_hashed(words(F.col("text"))), lambda h: _shingles(h, k))).alias("pos", "h"))
    found = rows.join(_held(shingles, small), "h").groupBy("doc_id", "version", "item_id", "m").agg(F.sum("w").alias("weight"), F.collect_set(F.struct("pos", "w")).alias("places"))
    weighed = items.select("item_id", "m", F.aggregate("pairs", F.lit(0).cast("long"), lambda s, p: s + p["w"]).alias("all"))
    # a window that reaches the similarity shares at least that part of the item's weight
    return found.join(_held(weighed, small), ["item_id", "m"]).where(F.col("weight") >= F.lit(similar) * F.col("all") - SLACK).select("doc_id", "version", "item_id", "m", "all", F.array_sort("places").alias("places"))


def _starts(k: int, similar: float) -> Column:
    """Where windows may start: every place t at which the shared shingles of the window weigh enough. The first of them is places[i]
    for the t that follow the place before it, so that each t is tried once and looks at m shingles at most."""
    reach = F.col("m") - k
    places = F.col("places")

    def after(p: Column, i: Column) -> Column:
        least = F.greatest(p["pos"] - reach, F.coalesce(F.get(places, i - 1)["pos"] + 1, F.lit(-(1 << 30))), -reach)
        near = F.slice(places, i + 1, reach + 1)
        held = lambda t: F.aggregate(F.filter(near, lambda x: x["pos"] <= t + reach), F.lit(0).cast("long"), lambda n, x: n + x["w"])
        return F.filter(F.transform(F.sequence(least, p["pos"]), lambda t: F.struct(t.alias("t"), held(t).alias("held"))), lambda x: x["held"] >= F.lit(similar) * F.col("all") - SLACK)

    return F.flatten(F.transform(places, after))


def _matches(docs: DataFrame, items: DataFrame, k: int, similar: float, radius: int, small: bool) -> DataFrame:
    """Matches of documents with the items."""
    docs = docs.withColumn("version", F.xxhash64("text"))
    able = written(_candidates(docs, items, k, similar, small), "candidates")
    n = able.agg(F.coalesce(F.sum(F.size("places") + F.lit(4)), F.lit(0))).first()[0]
    few = n <= BLOCK * 4  # numbers that a broadcast would hold
    rows = docs.join(_held(able, few), ["doc_id", "version"])
    tried = rows.withColumn("at", _starts(k, similar)).where(F.size("at") > 0)
    tried = tried.select("doc_id", "version", "item_id", "m", "all", words(F.col("text")).alias("_w"), "at").select("doc_id", "version", "item_id", "m", "all", "_w", F.explode("at").alias("x"))
    t = F.col("x.t")
    tried = tried.select("doc_id", "version", "item_id", "m", "all", F.greatest(t, F.lit(0)).alias("start"), F.col("x.held").alias("held"), F.slice("_w", F.greatest(t, F.lit(0)) + 1, F.col("m") + F.least(t, F.lit(0))).alias("_w"))
    whole = F.aggregate(_weights(F.transform("_w", lambda x: F.length(x)), k), F.lit(0).cast("long"), lambda n, w: n + w)
    most = F.least("held", "all", "whole")
    # held is at least the weight that window and item share, so none that is similar goes
    tried = tried.withColumn("whole", whole).where((F.col("whole") > 0) & (most >= F.lit(similar) * (F.col("all") + F.col("whole") - most) - SLACK))
    window = tried.select("doc_id", "version", "item_id", "m", "start", F.size("_w").alias("n_words"), _pairs(F.col("_w"), k).alias("pairs"))
    window = written(window.withColumn("fp", let(F.col("pairs"), simhash)), "windows")
    marked = items.withColumn("ifp", let(F.col("pairs"), simhash))
    # an item that shares no shingle with a window has a similarity of 0, so each window asks the index for the items that do
    index = marked.select("item_id", "m", "ifp", F.explode(_blocks(F.col("ifp"), radius)).alias("b")).select("item_id", "m", "ifp", "b.n", "b.bits")
    key = ["doc_id", "version", "item_id", "m", "start", "n_words"]
    asked = window.select(*key, "fp", F.explode(_blocks(F.col("fp"), radius)).alias("b")).select(*key, "fp", "b.n", "b.bits")
    near = asked.join(_held(index, small), ["item_id", "m", "n", "bits"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("ifp"))) <= radius).select(*key).distinct()
    bags = items.select("item_id", "m", let(F.col("pairs"), _bag).alias("ibag"))
    held = near.join(window.select(*key, "pairs").dropDuplicates(key), key).join(_held(bags, small), ["item_id", "m"])
    sure = held.withColumn("similarity", let(let(F.col("pairs"), _bag), lambda b: similarity(b, F.col("ibag")))).where(F.col("similarity") >= similar)
    best = F.min_by(F.struct("similarity", F.col("start").cast("long").alias("start_word"), F.col("n_words").cast("long").alias("n_words")), F.struct(-F.col("similarity"), "start", "m"))
    return sure.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.similarity", "best.start_word", "best.n_words")


def matches(docs: DataFrame, benchmark: DataFrame, similar: float = SIMILAR, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words): the best window of each document for each item that it leaks.

    A window has as many words as the item (fewer at a document's start or end) and matches if the weighted resemblance of the two bags of five-word
    shingles is at least similar. Items of fewer words are one shingle; items without words match nothing. Null texts are empty,
    rows without doc_id or item_id match nothing, rows that repeat count once; rows that repeat a doc_id with another text are tried each for itself.
    A benchmark of more than block shingles isn't broadcast but shuffled; documents are read twice either way.
    """
    docs = docs.where("doc_id is not null").select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sizes = benchmark.select(F.size(words(F.col("text"))).alias("m")).where("m > 0").groupBy(F.least("m", F.lit(WORDS)).alias("k")).agg(F.sum(F.col("m")).alias("n")).collect()  # at most five rows
    out = []
    for row in sorted(sizes):
        items = written(items_of(benchmark, None if row["k"] >= WORDS else row["k"]), "items")
        out.append(_matches(docs, items, row["k"], similar, radius, row["n"] <= block))
    if not out:
        return docs.select("doc_id", F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("similarity"), F.lit(0).cast("long").alias("start_word"), F.lit(0).cast("long").alias("n_words")).limit(0)
    return reduce(DataFrame.unionByName, out)


def decontaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """docs without those that leak an item; rows without doc_id stay."""
    bad = matches(docs, benchmark, **how).select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item that it leaks, with the best window."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
