"""A compression classifier of text quality: zstandard dictionaries of good and of bad labelled texts."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._util import small_batches, table

#: Labelled texts of each class that a model is fitted on at most: those of FIT_BYTES at most whose ids have the smallest hashes.
FIT_ROWS, FIT_BYTES = 1500, 1 << 16
#: Bytes of a dictionary, and of a piece of text that is compressed by itself: in short pieces the dictionary decides the size, not what the text repeats.
DICTIONARY, PIECE = 1600 << 10, 128
#: Texts shorter than this many bytes say less: their difference shrinks in proportion.
SHORT = 400
THRESHOLD = 0.3


class CompressionModel:
    """Two dictionaries of good and of bad text, and the curve that calibrates the difference of the compressed sizes that they give."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.good, self.bad = good, bad
        self.line, self.steps = (1.0, 0.0), ([0.0], [0.5])
        self._ready: tuple | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_ready": None}

    def sizes(self, text: bytes) -> tuple[int, int]:
        """Compressed size of the whole text, piece by piece, with the good dictionary and with the bad one."""
        if self._ready is None:
            made = []
            for raw in (self.good, self.bad):
                d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=3)
                made.append(zstandard.ZstdCompressor(dict_data=d, level=3, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
            self._ready = tuple(made)
        pieces = [text[a : a + PIECE] for a in range(0, len(text), PIECE)]
        return sum(len(self._ready[0](p)) for p in pieces), sum(len(self._ready[1](p)) for p in pieces)

    def difference(self, text: bytes) -> float:
        """How much smaller the good dictionary makes the text than the bad one, for each of its bytes; 0 of an empty text."""
        if not text:
            return 0.0
        good, bad = self.sizes(text)
        return min(1.0, len(text) / SHORT) * (bad - good) / len(text)

    def score(self, text: bytes) -> float:
        """The calibrated difference: it never falls where the difference rises."""
        x = self.difference(text)
        z = self.line[0] * x + self.line[1]
        logistic = 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))
        return 0.9 * float(np.interp(x, *self.steps)) + 0.1 * logistic

    def calibrate(self, texts: list[bytes], labels: list[int], good_share: float, rounds: int = 60) -> None:
        """A logistic line (Newton's method with halved steps) and, where it bends, the isotonic means of the labels (pooled adjacent violators).

        Each class weighs what its share of all labels is.
        """
        x, y = np.array([self.difference(t) for t in texts]), np.array(labels, float)
        weigh = np.where(y == 1, good_share / (y == 1).sum(), (1 - good_share) / (y == 0).sum()) * len(y)
        m, w = np.stack([x, np.ones(len(x))], 1), np.zeros(2)

        def loss(w: np.ndarray) -> float:
            return float((weigh * np.logaddexp(0, np.where(y == 1, -1, 1) * (m @ w))).sum() + 5e-5 * w @ w)

        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(m @ w, -60, 60)))
            step = np.linalg.solve((m * (weigh * p * (1 - p))[:, None]).T @ m + 1e-4 * np.eye(2), m.T @ (weigh * (y - p)) - 1e-4 * w)
            while loss(w + step) > loss(w) and abs(step).max() > 1e-9:
                step = step / 2
            w = w + step
            if abs(step).max() < 1e-8:
                break
        self.line = tuple(w.tolist())
        pools: list[list[float]] = []  # sum of x, of y, of weights, and rows
        for i in np.argsort(x, kind="stable"):
            pools.append([x[i] * weigh[i], y[i] * weigh[i], weigh[i], 1])
            # a mean of a few rows says little, so pools have twenty at least
            while len(pools) > 1 and (pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2] or pools[-2][3] < 20):
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.steps = ([p[0] / p[2] for p in pools], [(p[1] + 0.01) / (p[2] + 0.02) for p in pools])


def _dictionary(texts: list[bytes]) -> bytes:
    """Pieces of the texts in an order that their hashes give, up to the size of a dictionary."""
    pieces = sorted((t[a : a + PIECE] for t in texts for a in range(0, len(t), PIECE)), key=lambda p: hashlib.md5(p).digest())
    return b"".join(pieces)[:DICTIONARY] or b"\0" * 8


def fit(good: list[bytes], bad: list[bytes], good_share: float = 0.5) -> CompressionModel:
    """Dictionaries from every other text, the curve from the others."""
    model = CompressionModel(_dictionary(good[::2]), _dictionary(bad[::2]))
    rest, labels = good[1::2] + bad[1::2], [1] * len(good[1::2]) + [0] * len(bad[1::2])
    if len(set(labels)) == 2:
        model.calibrate(rest, labels, min(max(good_share, 0.01), 0.99))
    return model


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def fit_on(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> CompressionModel:
    """A model of the labelled documents that aren't held out: rows of each class at most, by the hash of their id.

    Null labels, ids and texts teach nothing, nor do texts of more than FIT_BYTES, so that what the driver gets is bounded; a document that is labelled
    twice counts as the worse. Without both classes the curve is the one that CompressionModel begins with.
    """
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("_quality")).where("_quality in (0, 1)")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("_quality = 1").orderBy(*order).limit(rows).union(known.where("_quality = 0").orderBy(*order).limit(rows))
    share = known.agg(F.avg(F.col("_quality").cast("double"))).first()[0]
    # at most 2 * rows ids
    got = docs.select("doc_id", "text").where(F.octet_length("text") <= FIT_BYTES).join(F.broadcast(chosen), "doc_id").select("doc_id", F.encode("text", "UTF-8").alias("text"), "_quality").collect()
    got.sort(key=lambda r: (r["doc_id"], bytes(r["text"])))
    by = {q: [bytes(r["text"]) for r in got if r["_quality"] == q] for q in (0, 1)}
    return fit(by[1], by[0], 0.5 if share is None else share)


def scored(docs: DataFrame, model: CompressionModel, text: str = "text") -> DataFrame:
    """docs with score and predicted of every whole text, in place of columns of these names; a null text scores as an empty one. Needs no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # two dictionaries and a curve of some hundred numbers

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        held = shared.value
        return texts.map(lambda t: held.score((t or "").encode()))

    return docs.withColumn("score", score(F.coalesce(F.col(text), F.lit("")))).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op6_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score, by a model of the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    return scored(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
