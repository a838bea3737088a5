"""Document fingerprints: threshold-scaled sketches of byte shingles."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hashing
from ._util import partitions, small_batches, table

#: Bytes of a shingle, and the share of hashes that a sketch retains, 1 / SCALE: a fingerprint takes about a sixth of its text's bytes.
WIDTH, SCALE = 16, 32
#: Bytes that are hashed at a time.
SPAN = 1 << 20


def sketch(text: bytes, width: int = WIDTH, scale: int = SCALE) -> np.ndarray:
    """Sorted distinct hashes below 2 ** 64 / scale of all shingles, cut to 32 bits: whether a hash is kept depends on nothing but the hash.

    A text shorter than a shingle is one shingle; a short text may have an empty sketch, an empty one has. The sketch of texts taken together is the
    union of theirs, as long as shingles across the seam don't count.
    """
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint32)
    limit, kept = np.uint64((1 << 64) // scale - 1), []
    for at in range(0, max(1, len(data) - width + 1), SPAN):
        h = hashing.windows(data[at : at + SPAN + width - 1], min(width, len(data)))
        kept.append(h[h <= limit])
    return np.unique((np.concatenate(kept) // np.uint64(max(1, (1 << 32) // scale))).astype(np.uint32))


def whole(text: bytes) -> int:
    """A hash of the whole text in 32 bits, which tells apart texts whose sketches are empty."""
    return zlib.crc32(text)


def text_of(held: np.ndarray, mark: int = 0, width: int = WIDTH, scale: int = SCALE) -> str:
    """A fingerprint: shingle width and scale, the mark of the whole text, the sketch."""
    return f"s{width}/{scale}:{mark:08x}:{base64.b64encode(held.astype('>u4').tobytes()).decode()}"


def parsed(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.split(":")[2]), ">u4").astype(np.uint32)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.union1d(a, b)


def likeness(a: np.ndarray, b: np.ndarray, same: bool = False) -> float:
    """Estimated resemblance, 0 to 1; same says whether the texts' marks are the same, which decides between two empty sketches. An empty one is like no other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b) and same)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b has, however unequal the two are; 1 of an empty a."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with the column fingerprint of each whole text; needs no shuffle. A null text is empty."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_of(sketch(raw := (t or "").encode()), whole(raw)))

    return docs.withColumn("fingerprint", of(F.coalesce(F.col(text), F.lit(""))))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", per_task: int = 4) -> DataFrame:
    """Rows (range, role, key, text), to be read range by range in the order of (role, key, text).

    Keys are cut into ranges; a range also holds, with role 1, the first rows of the range after it (after the last: of the first),
    so that every document meets its successor without a task that holds all. Null keys come first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k"), F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = per_task * partitions(spark)
    cuts = sorted({int(x) for x in rows.select("k").where("key is not null").stat.approxQuantile("k", [i / n for i in range(1, n)], 0.1 / n)}) if n > 1 else []
    cuts = np.array(cuts, np.int64)

    @F.arrow_udf(T.IntegerType())
    def range_of(k: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(cuts, k.to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    # as many rows as there are ranges
    first = sorted((r["range"], r["k"]) for r in rows.select("k", range_of("k").alias("range")).groupBy("range").agg(F.min("k").alias("k")).collect())
    heads = {k: first[i - 1][0] for i, (_, k) in enumerate(first)}

    @F.arrow_udf(T.IntegerType())
    def before_of(k: pa.Array) -> pa.Array:
        return pa.array([heads.get(x, -1) for x in k.to_pylist()], pa.int32())

    placed = rows.withColumn("range", range_of("k")).withColumn("before", before_of("k"))
    ahead = F.struct(F.col("before").alias("range"), F.lit(1).alias("role"))
    own = F.struct(F.col("range"), F.lit(0).alias("role"))
    return placed.withColumn("place", F.explode(F.when(F.col("before") >= 0, F.array(own, ahead)).otherwise(F.array(own)))).select("place.range", "place.role", "k", "key", "text")


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of its edited text and that of its successor: see op7 in the README.

    The edited text has its last half (rounded down, in code points) replaced by the first as many of the next document by key.
    Rows that repeat a key follow each other by text; a single document succeeds itself; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # (range, key, text, sketch, mark) that waits for its successor

        def finished(last: tuple, after: str, own: np.ndarray, next_mark: int) -> tuple:
            _, doc, full, fp, mark = last
            half = len(full) // 2
            edited = (full[: len(full) - half] + after[:half]).encode()
            new, new_mark = sketch(edited), whole(edited)
            return doc, len(full), hashlib.sha256(edited).hexdigest(), text_of(fp, mark), text_of(new, new_mark), likeness(fp, new, mark == new_mark), likeness(fp, own, mark == next_mark)

        for batch in batches:
            out = []
            for at, role, doc, full in zip(*(batch.column(c).to_pylist() for c in ("range", "role", "key", "text")), strict=True):
                if role and (held is None or held[0] != at):
                    continue  # only the first row ahead counts
                fp, mark = sketch(raw := full.encode()), whole(raw)
                if held is not None and held[0] == at:
                    out.append(finished(held, full, fp, mark))
                held = None if role else (at, doc, full, fp, mark)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(shape)], schema=shape)

    shape = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    rows = with_next(docs, key, text)
    dealt = rows.repartition(partitions(docs.sparkSession), "range").sortWithinPartitions("range", "role", "k", "text")
    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op7_scaled_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))
