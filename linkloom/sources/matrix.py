"""Dense vectors as one file of little-endian float32, row after row, with a small JSON file of their hash, rows and width beside it."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a task reads at a time.
ROWS = 4096


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """Arrow's filesystem of an address, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/*", "file:///", path if "://" in path or path.startswith("file:") else f"file://{path}")))


def pooled(states: Column, mask: Column) -> Column:
    """The mean of the rows of states (array of arrays) whose mask is 1, with length 1; of none, zeros."""
    width = F.size(F.get(states, F.lit(0)))
    kept = F.transform(F.filter(F.arrays_zip(states.alias("s"), mask.alias("m")), lambda x: x["m"] == 1), lambda x: x["s"])
    total = F.aggregate(kept, F.array_repeat(F.lit(0.0), width), lambda a, s: F.zip_with(a, s, lambda x, y: x + y.cast("double")))
    mean = F.transform(total, lambda x: x / F.greatest(F.size(kept).cast("double"), F.lit(1e-9)))
    norm = F.greatest(F.sqrt(F.aggregate(mean, F.lit(0.0), lambda a, x: a + x * x)), F.lit(1e-9))
    return F.transform(mean, lambda x: (x / norm).cast("float"))


def write(vectors: DataFrame, path: str, digest: str, key: str = "entry_id", column: str = "embedding") -> dict:
    """Writes the vectors in the order of key to path and their metadata to path with .json for its ending, each under another name first.

    The file is one stream, so one task writes it, a batch at a time. Returns the metadata.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, to = filesystem(path)
        beside, rows, dim = f"{to}.{uuid.uuid4().hex}", 0, 0
        with fs.open_output_stream(beside) as out:
            for batch in batches:
                for v in batch.column("v"):
                    x = np.asarray(v.values.to_numpy(zero_copy_only=False), "<f4")
                    dim = dim or len(x)
                    if len(x) != dim:
                        raise ValueError(f"a vector of {len(x)} numbers among those of {dim}")
                    out.write(x.tobytes())
                    rows += 1
        fs.move(beside, to)
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64()), "dim": pa.array([dim], pa.int64())})

    got = vectors.select(F.col(key).alias("k"), F.col(column).alias("v")).repartition(1).sortWithinPartitions("k").mapInArrow(run, "rows long, dim long").first()
    meta = {"hash": digest, "rows": got["rows"], "dim": got["dim"]}
    fs, to = filesystem(re.sub(r"\.[^./]*$", "", path) + ".json")
    beside = f"{to}.{uuid.uuid4().hex}"
    with fs.open_output_stream(beside) as out:
        out.write(json.dumps(meta, separators=(",", ":")).encode() + b"\n")
    fs.move(beside, to)
    return meta


def metadata(path: str) -> tuple[dict, int]:
    """(metadata, bytes) of a file of vectors; empty and 0 where they are missing or unreadable."""
    fs, at = filesystem(path)
    try:
        with fs.open_input_stream(re.sub(r"\.[^./]*$", "", at) + ".json") as of:
            meta = json.loads(of.read())
    except (OSError, ValueError):
        meta = {}
    info = fs.get_file_info(at)
    return meta, info.size or 0


def read(spark: SparkSession, path: str, dim: int, rows: int | None = None) -> DataFrame:
    """(row, embedding), row from 0; tasks read ranges of the file. Raises ValueError where it doesn't hold rows vectors of dim numbers."""
    fs, at = filesystem(path)
    size = fs.get_file_info(at).size or 0
    n, rest = divmod(size, 4 * dim)
    if rest or (rows is not None and n != rows):
        raise ValueError(f"{size} bytes are not {'whole' if rows is None else rows} rows of {dim} numbers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = filesystem(path)
        with fs.open_input_file(at) as of:
            for batch in batches:
                for first in batch.column("id").to_pylist():
                    many = min(ROWS, n - first)
                    x = np.frombuffer(of.read_at(4 * dim * many, 4 * dim * first), "<f4")
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, first + many)), pa.ListArray.from_arrays(pa.array(np.arange(0, dim * many + 1, dim), pa.int32()), pa.array(x))], ["row", "embedding"])

    return spark.range(0, n, ROWS).mapInArrow(run, "row long, embedding array<float>")
