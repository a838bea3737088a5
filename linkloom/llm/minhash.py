"""MinHash near-dedup by an LSH forest, with links confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._util import partitions, small_batches, table, written
from .components import components

#: Sorted orders of signatures, and hashes that two documents must share at an order's front to be candidates. A link of
#: similarity 0.8 shares the front of none of the orders with a chance of (1 - 0.8 ** 4) ** 24 = 3e-6.
TREES, DEPTH = 24, 4
#: A front shared by more documents than this is a dense region: there the prefix grows, byte by byte of the signature, until
#: fewer share it or it is as long as DEEPEST.
DENSE, DEEPEST = 64, 24
#: Bits of the map that says which documents can be asked for; its size is fixed, so it may be collected and broadcast.
MAP_BITS = 1 << 24
#: Equal bytes of two signatures of TREES * DEPTH hashes that candidates need: a pair of similarity 0.8 has fewer with a chance below 1e-6.
SLACK = 5.4
#: Documents of a dense region that a task compares with each other: some that aren't linked into the region's largest class, and members.
LEFT, MEMBERS = 256, 1024

_rng = np.random.Generator(np.random.PCG64(20))
_A = (_rng.integers(0, 1 << 32, (TREES * DEPTH, 1), dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_B = _rng.integers(0, 1 << 32, (TREES * DEPTH, 1), dtype=np.uint32)
_U = np.uint64


def shingles(text: bytes, k: int) -> tuple[np.ndarray, bytes]:
    """Sorted distinct 64-bit hashes of the k-word shingles (of the whole sequence if there are fewer words), and a key of the word sequence."""
    words = text.lower().split()  # of bytes: lower-cases A-Z, cuts at ASCII white space
    key = hashlib.md5(b" ".join(words)).digest()
    n = len(words)
    if not n:
        return np.zeros(0, _U), key
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, n)
    width = min(k, n)
    s = h[: n - width + 1].copy()
    for j in range(1, width):
        s = (s ^ (s >> _U(29))) * _U(0x9E3779B97F4A7C15) + h[j : n - width + 1 + j]
    s = (s ^ (s >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return np.unique(s ^ (s >> _U(32))), key


def signature(s: np.ndarray) -> np.ndarray:
    """Least value of each of TREES * DEPTH hashes over a set that isn't empty."""
    low = (s >> _U(32)).astype(np.uint32)
    out = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 4096):
        y = (low[None, at : at + 4096] ^ _B) * _A
        out = np.minimum(out, (y ^ (y >> np.uint32(15))).min(axis=1))
    return out


def _signed(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, key, n, fronts: 24 longs, sig: 96 bytes); fronts and sig are null of an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ns, fronts, sigs = [], [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                s, key = shingles(text or b"", k)
                keys.append(key)
                ns.append(len(s))
                if len(s):
                    sig = signature(s)
                    four = sig.reshape(TREES, DEPTH).astype(_U)
                    f = np.arange(TREES, dtype=_U)
                    for j in range(DEPTH):
                        f = (f ^ (f >> _U(31))) * _U(0xBF58476D1CE4E5B9) + four[:, j]
                    fronts.append(((f ^ (f >> _U(29))) * _U(0x94D049BB133111EB)).view(np.int64))
                    sigs.append((sig * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8).tobytes())
                else:
                    fronts.append(None)
                    sigs.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(ns, pa.int64()), pa.array(fronts, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], ["doc_id", "key", "n", "fronts", "sig"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, key binary, n long, fronts array<long>, sig binary")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple]]]:
    """Groups of rows that follow each other with one first column, across batches."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    for k, group in groupby(rows(), key=lambda r: r[0]):
        yield k, list(group)


def _near(ids: np.ndarray, sig: np.ndarray, least: int, out: list) -> None:
    """All pairs of at most DENSE documents whose signatures agree in enough bytes."""
    for i in range(len(ids) - 1):
        near = np.count_nonzero(sig[i + 1 :] == sig[i], axis=1)
        hit = np.flatnonzero(near >= least)
        if len(hit):
            other = ids[i + 1 :][hit]
            out.append((np.minimum(other, ids[i]), np.maximum(other, ids[i]), near[hit]))


def _best(ids: np.ndarray, sig: np.ndarray, least: int, out: list) -> None:
    """The nearest two of each of at most DENSE documents, if near enough."""
    near = np.count_nonzero(sig[:, None, :] == sig[None, :, :], axis=2)
    np.fill_diagonal(near, -1)
    for _ in range(min(2, len(ids) - 1)):
        j = near.argmax(axis=1)
        n = near[np.arange(len(ids)), j]
        hit = np.flatnonzero(n >= least)
        if len(hit):
            out.append((np.minimum(ids[hit], ids[j[hit]]), np.maximum(ids[hit], ids[j[hit]]), n[hit]))
        near[np.arange(len(ids)), j] = -1


def _pair_batch(out: list) -> pa.RecordBatch:
    a, b, n = (np.concatenate(x) for x in zip(*out, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int32))], ["a", "b", "near"])


def _near_pairs(groups: DataFrame, spark: SparkSession, least: int) -> DataFrame:
    """(a, b, near): pairs of each group of at most DENSE rows (g, doc_id, sig) whose signatures agree in enough bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches):
            out: list = []
            _near(np.array([r[1] for r in rows], np.int64), np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1), least, out)
            if out:
                yield _pair_batch(out)

    dealt = groups.select("g", "doc_id", "sig").repartition(partitions(spark), "g").sortWithinPartitions("g")
    return dealt.mapInArrow(run, "a long, b long, near int").where("a <> b")


def _dense_pairs(dense: DataFrame, spark: SparkSession, least: int) -> DataFrame:
    """The same for rows (front, sig, doc_id) of dense regions: a sorted order of the signatures is cut into ranges, and in each
    range neighbours are those with the longest common prefixes: the nearest two of each document under a prefix that at most DENSE documents
    share, and the first and each other one where even the longest prefix is shared by more. Ranges cut regions wherever they
    fall; all other links of a region are found in blocks."""

    def split(t: np.ndarray, ids: np.ndarray, depth: int, out: list) -> None:
        stack = [(0, len(ids), depth)]
        while stack:
            lo, hi, depth = stack.pop()
            if hi - lo <= DENSE:
                _best(ids[lo:hi], t[lo:hi], least, out)
            elif depth == DEEPEST:
                near = np.count_nonzero(t[lo + 1 : hi] == t[lo], axis=1)
                hit = np.flatnonzero(near >= least)
                other = ids[lo + 1 : hi][hit]
                out.append((np.minimum(other, ids[lo]), np.maximum(other, ids[lo]), near[hit]))
            else:
                col = t[lo:hi, depth]
                cut = [lo, *(lo + 1 + np.flatnonzero(col[1:] != col[:-1])).tolist(), hi]
                stack += [(x, y, depth + 1) for x, y in zip(cut[:-1], cut[1:], strict=True) if y - x > 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches):
            out: list = []
            if len(rows) > 1:
                split(np.frombuffer(b"".join(r[1] for r in rows), np.uint8).reshape(len(rows), -1), np.array([r[2] for r in rows], np.int64), 0, out)
            if out:
                yield _pair_batch(out)

    dealt = dense.select("front", "turned", "doc_id").repartitionByRange(partitions(spark), "front", "turned", "doc_id").sortWithinPartitions("front", "turned", "doc_id")
    return dealt.mapInArrow(run, "a long, b long, near int").where("a <> b")


def _linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return den * both >= num * (len(x) + len(y) - both)


def _confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(u, v) of the pairs (a, b) that are links on the full sets (doc_id, s)."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            keep = [_linked(np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U), num, den) for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, k in zip(a, keep, strict=True) if k], pa.int64()), pa.array([x for x, k in zip(b, keep, strict=True) if k], pa.int64())], ["u", "v"])

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "u long, v long")


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(doc_id, s): the full shingle sets of some documents, recomputed from their texts.

    A bit map of fixed size lets most other texts go before anything moves; a join with the ids does the rest. On a corpus with far more
    candidates than bits the map lets all pass, and the result is the same.
    """
    spark = docs.sparkSession
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(MAP_BITS))
    words = ids.select(slot.alias("h")).groupBy(F.shiftright("h", 6).cast("int").alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits")).toPandas()
    held = np.zeros(MAP_BITS // 64, np.int64)
    held[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            keep = pa.array((bits[h >> 6] >> (h & 63)) & 1 == 1)
            part = batch.filter(keep)
            s = [shingles(t or b"", k)[0].tobytes() for t in part.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s, pa.binary())], ["doc_id", "s"])

    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null").withColumn("h", slot)
    return asked.mapInArrow(run, "doc_id long, s binary").join(ids, "doc_id", "left_semi")


def _block_links(blocks: DataFrame, spark: SparkSession, num: int, den: int) -> DataFrame:
    """(u, v): in each block (g, doc_id, class, left, s), links of documents that are left to members of other classes, one for each such class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches):
            rows = list({(r[1], r[3]): r for r in rows}.values())
            left, members = [r for r in rows if r[3]], [r for r in rows if not r[3]]
            if not left or not members:
                continue
            sets = [np.frombuffer(r[4], _U) for r in members]
            sizes = np.array([len(s) for s in sets])
            words, code = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            classes = np.array([r[2] for r in members], np.int64)
            ids = np.array([r[1] for r in members], np.int64)
            u, v = [], []
            for r in left:
                s = np.frombuffer(r[4], _U)
                at = np.minimum(np.searchsorted(words, s), len(words) - 1)
                mark = np.zeros(len(words), np.int32)
                mark[at[words[at] == s]] = 1
                both = np.add.reduceat(mark[code], starts)
                hit = np.flatnonzero((den * both >= num * (sizes + len(s) - both)) & (classes != r[2]))
                if len(hit):
                    _, first = np.unique(classes[hit], return_index=True)
                    u += [r[1]] * len(first)
                    v += ids[hit[first]].tolist()
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    dealt = blocks.select("g", "doc_id", "class", "left", "s").repartition(partitions(spark), "g").sortWithinPartitions("g")
    return dealt.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, words: int = 5, similar: tuple[int, int] = (80, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs (doc_id, text); other columns aren't read.

    Documents are linked if num * union <= den * intersection of their sets of shingles, (num, den) being similar. component_id is
    the smallest doc_id reachable, kept whether it is the own one. Texts that are null or without words have the
    empty set and no links; rows that repeat a doc_id are one document in links and stay rows; a null doc_id has a null component and isn't kept.

    1. Documents with the same words are one class; its smallest doc_id stands for it.
    2. The LSH forest: TREES sorted orders of the signature; documents with a longest common prefix of DEPTH hashes are neighbours. In a dense
       region the prefix grows until at most DENSE documents share it; those that share even the longest are neighbours of the first.
    3. Neighbours whose signatures are near are confirmed on full sets: for each document first the nearest two, then those that are in
       other components still.
    4. What a dense region may have lost by its longer prefixes: its documents outside its largest component are compared exactly with all of it, in blocks.
    """
    spark = docs.sparkSession
    small_batches(spark)
    num, den = similar
    n_hash = TREES * DEPTH
    share = num / den
    least = max(1, int(n_hash * share - SLACK * (n_hash * share * (1 - share)) ** 0.5)) if share < 1 else n_hash
    signed = written(_signed(docs, words), "signatures")
    # aggregates are written before they are joined, so that both sides are plain exchanges whose large partitions adaptive execution can split
    reps = written(signed.where("n > 0 and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("rep")), "first-of-class")
    alike = signed.where("n > 0 and doc_id is not null").join(reps, "key")
    mine = written(alike.where("doc_id = rep").dropDuplicates(["doc_id"]).select("doc_id", "fronts", "sig"), "representatives")

    # 2. fronts that several documents share
    fronts = mine.select("doc_id", F.explode("fronts").alias("front"))
    shared = fronts.groupBy("front").agg(F.count(F.lit(1)).alias("many"), F.min("doc_id").alias("first")).where("many > 1")
    members = written(fronts.join(shared, "front"), "fronts")
    some = members.select("doc_id").distinct()
    sigs = mine.select("doc_id", "sig").join(some, "doc_id", "left_semi")
    met = members.join(sigs, "doc_id")
    sparse = met.where(F.col("many") <= DENSE).select(F.col("front").alias("g"), "doc_id", "sig")
    # the prefix goes on with other bytes of the signature, in an order that the front gives
    turn = f"cast(pmod(front, {n_hash}) as int)"
    turned = F.concat(F.expr(f"substring(sig, {turn} + 1, {n_hash})"), F.expr(f"substring(sig, 1, {turn})"))
    dense = written(met.where(F.col("many") > DENSE).select("doc_id", "front", "first", turned.alias("turned")), "dense")
    close = _near_pairs(sparse, spark, least).unionByName(_dense_pairs(dense, spark, least))
    pairs = written(close.groupBy("a", "b").agg(F.max("near").alias("near")), "pairs")

    # 3. the nearest two of each document, then what is still apart
    ends = pairs.select(F.col("b").alias("x"), "a", "b", "near").union(pairs.select(F.col("a").alias("x"), "a", "b", "near"))
    rank = F.row_number().over(Window.partitionBy("x").orderBy(F.col("near").desc(), "a", "b"))
    best = ends.withColumn("rank", rank).where("rank <= 2").select("a", "b").distinct()
    regions = components(dense.where("doc_id <> first").select(F.col("doc_id").alias("u"), F.col("first").alias("v")))
    asked = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).union(regions.select(F.col("id").alias("doc_id"))).distinct()
    sets = written(_sets(docs, asked, words).dropDuplicates(["doc_id"]), "sets")
    links = written(_confirmed(best, sets, num, den), "links")
    parts = components(links)
    of = parts.select(F.col("id").alias("_id"), "component")
    apart = pairs.join(of.withColumnsRenamed({"_id": "a", "component": "ca"}), "a", "left").join(of.withColumnsRenamed({"_id": "b", "component": "cb"}), "b", "left")
    apart = apart.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b").join(best, ["a", "b"], "left_anti")
    more = _confirmed(apart, sets, num, den)

    # 4. dense regions: whoever isn't in the largest component of its region, against all of it
    placed = regions.withColumnRenamed("component", "region").join(of, F.col("id") == F.col("_id"), "left")
    placed = written(placed.select(F.col("id").alias("doc_id"), "region", F.coalesce("component", "id").alias("class")), "regions")
    sizes = placed.groupBy("region", "class").agg(F.count(F.lit(1)).alias("size"))
    top = sizes.groupBy("region").agg(F.max(F.struct("size", "class")).alias("top"), F.sum("size").alias("all"))
    marked = placed.join(top, "region").where(F.col("all") > F.col("top.size")).withColumn("left", F.col("class") != F.col("top.class"))
    counts = marked.groupBy("region", "top", "all").agg(F.sum(F.col("left").cast("long")).alias("n_left")).select("region", F.ceil(F.col("n_left") / LEFT).cast("int").alias("ls"), F.ceil(F.col("all") / MEMBERS).cast("int").alias("ms"))
    cut = marked.join(counts, "region").join(sets, "doc_id")
    # hashes deal the region's documents to blocks; every one of them is in a block with every one that is left
    l_of, m_of = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("ls")), F.pmod(F.xxhash64("doc_id", F.lit(2)), F.col("ms"))
    as_left = cut.where("left").select("region", "doc_id", "class", F.lit(True).alias("left"), "s", l_of.alias("l"), F.explode(F.sequence(F.lit(0), F.col("ms") - 1)).alias("m"))
    as_member = cut.select("region", "doc_id", "class", F.lit(False).alias("left"), "s", F.explode(F.sequence(F.lit(0), F.col("ls") - 1)).alias("l"), m_of.alias("m"))
    blocks = as_left.unionByName(as_member).withColumn("g", F.xxhash64("region", "l", "m"))
    late = _block_links(blocks, spark, num, den)

    final = written(components(links.union(more).union(late)), "components")
    found = alike.select("doc_id", "rep").join(final.select(F.col("id").alias("rep"), "component"), "rep", "left").select("doc_id", F.coalesce("component", "rep").alias("component"))
    found = found.groupBy("doc_id").agg(F.min("component").alias("component"))
    out = signed.select("doc_id", F.col("n").alias("n_shingles")).join(found, "doc_id", "left")
    # a component's name is the smallest doc_id of its representatives, each the smallest of its class
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(False)).alias("kept"))


def deduplicated(docs: DataFrame, words: int = 5, similar: tuple[int, int] = (80, 100)) -> DataFrame:
    """docs with one document of each group, that with the smallest doc_id; rows without doc_id stay."""
    gone = near_duplicates(docs, words, similar).where("doc_id is not null and not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op1_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set's size and its component, of two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


#: All pairs that share a shingle, and their closure: what SQL can do on small tables.
OP1_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, hash(unnest(s)) AS h FROM s),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(a, b) AS (SELECT x, y FROM ways UNION SELECT r.a, k.y FROM reach r JOIN ways k ON r.b = k.x),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(m, n.doc_id)) AS component_id, n.doc_id = least(n.doc_id, coalesce(m, n.doc_id)) AS kept FROM n LEFT JOIN least ON a = n.doc_id
"""
