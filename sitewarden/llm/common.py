"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewarden.session import fits

# Characters that one step of a vectorised operator holds, besides the one text that may be longer.
STEP_CHARS = 2_000_000
# Rows of a few numbers that every executor may hold.
MAX_BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(df: DataFrame) -> DataFrame:
    """`df`, a table of a few numbers a row, to be broadcast if it is proven to have no more than MAX_BROADCAST_ROWS rows."""
    return F.broadcast(df) if fits(df, MAX_BROADCAST_ROWS) else df


def steps(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about `limit` bytes of text; each has at least one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if len(sizes) > start:
        yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of a column as bytes; null is empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def strings(column: pa.Array) -> list[str]:
    """The texts of a column; null is empty."""
    return pc.fill_null(column, "").to_pylist()
