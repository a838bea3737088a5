"""From raw documents to token files: five stages, each of one operator of linkloom.llm.

Each stage takes all that its predecessor kept and returns the columns of documents; the last one returns what it reads back from its
token files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkloom.llm._util import table, written
from linkloom.llm.decontamination import decontaminated
from linkloom.llm.minhash import deduplicated
from linkloom.llm.mixing import mix, shuffle_key
from linkloom.llm.quality import fit_on, scored
from linkloom.llm.tokens import token_files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = fit_on(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model).where("predicted = 1").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8 or more."""
    return deduplicated(docs, words=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources take part by the root of their size; documents are repeated by Poisson counts and shuffled globally.

    Copies keep their doc_id; rows are written in the shuffled order.
    """
    return mix(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Wavelet matrix files of the token ids in the mixture's shuffled order, and what is read back from them.

    Rows of a table have no order, so the order comes from the ids again: the mixture's own key of seed, doc_id and the copy's number among its likes.
    """
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("n_chars")) - 1
    return token_files(docs.select("doc_id", "text", "n_chars").withColumn("copy", copy), order=shuffle_key(F.col("doc_id"), F.col("copy")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: The classifier, the forest and the tokenizer are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
