"""What the operators of this package share: the shared folder, written tables, row numbers."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows in one Arrow batch: texts may be long, so batches are kept small.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session gets one of its own (tests); a cluster has
    to name one, since a machine's own folder would be another on every executor."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.gettempdir()}/linkloom-shared-{spark.sparkContext.applicationId}"
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/linkloom/{name}-{uuid.uuid4().hex}"


def filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's filesystem of a folder's address, and the path in it. Addresses that only Hadoop's names differ in are put in Arrow's: s3a and s3n as
    s3, abfss as abfs, dbfs as the folder under which it is mounted."""
    for pattern, put in ((r"^file:/*", "file:///"), (r"^s3[an]:", "s3:"), (r"^abfss:", "abfs:"), (r"^dbfs:/*", "file:///dbfs/")):
        folder = re.sub(pattern, put, folder)
    return pyarrow.fs.FileSystem.from_uri(folder)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows that one Arrow batch carries to Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > BATCH_ROWS or int(spark.conf.get(key, "10000")) <= 0:
        spark.conf.set(key, str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """Gapless numbers from 0 within each group, without a task that holds a whole group.

    Rows are dealt by range over (group, order), numbered inside their partition, and moved by
    the counts of the partitions before. Ties get any of their numbers. df is written once; a column out is replaced.
    """
    df = df.drop(out)
    n, pid, row = partitions(df.sparkSession), f"{out}__pid", f"{out}__row"
    cols = [F.col(c) for c in [*group, *order]]
    dealt = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    at = F.monotonically_increasing_id()
    dealt = written(dealt.withColumn(pid, F.shiftright(at, 33)).withColumn(row, at.bitwiseAND(F.lit((1 << 33) - 1))), "numbered")
    blocks = dealt.groupBy(*group, pid).agg(F.count(F.lit(1)).alias(f"{out}__n"), F.min(row).alias(f"{out}__first"))
    # one row for each partition and group that meet: about partitions + groups of them
    before = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    right = blocks.select(*[F.col(g).alias(f"{out}__g{k}") for k, g in enumerate(group)], F.col(pid).alias(f"{out}__p"), f"{out}__first", F.coalesce(F.sum(f"{out}__n").over(before), F.lit(0)).alias(f"{out}__offset"))
    same = F.col(pid) == F.col(f"{out}__p")
    for k, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"{out}__g{k}"))
    return dealt.join(right, same).withColumn(out, (F.col(row) - F.col(f"{out}__first") + F.col(f"{out}__offset")).cast("long")).select(*df.columns, out)


def unit(*cols: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of the columns, the same in any engine."""
    digest = F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def let(value: Column, body) -> Column:
    """body(value), value being computed once for a row however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
