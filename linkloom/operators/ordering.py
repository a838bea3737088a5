"""Gapless numbers in a global order without a task that holds all rows, and the folder that such steps share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session may do without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/linkloom-{spark.sparkContext.applicationId}"


def numbered(rows: DataFrame, order: list[Column], out: str = "rank", first: int = 1) -> DataFrame:
    """rows with gapless numbers in the given order, from first on: dealt by ranges, numbered inside them and moved by the counts of the
    ranges before. rows are written once; a column out is replaced. Ties get any of their numbers."""
    spark = rows.sparkSession
    rows = rows.drop(out)
    path, pid, row = f"{shared_folder(spark)}/ranking-{uuid.uuid4().hex}", f"{out}__pid", f"{out}__row"
    at = F.monotonically_increasing_id()
    dealt = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    dealt = dealt.withColumns({pid: F.shiftright(at, 33), row: at.bitwiseAND(F.lit((1 << 33) - 1))})
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    # one row a partition
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(pid).agg(F.count(F.lit(1)).alias("n")).select(pid, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(f"{out}__offset"))
    return dealt.join(F.broadcast(offsets), pid).withColumn(out, (F.col(row) + F.col(f"{out}__offset") + first).cast("long")).select(*rows.columns, out)
