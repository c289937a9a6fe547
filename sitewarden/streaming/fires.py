"""Continuous fire feed: parse, drop repeats within the watermark, append and count."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitewarden.constants import NEAR_DUPLICATE_M
from sitewarden.functions.cells import GeoGrid
from sitewarden.sources.hazards import FIRE_CSV_COLUMNS, parse_fires

WATERMARK = "10 days"
_NO_SEPARATOR = "\u0001"  # not a character of a text feed
_STEP_LINES = 8192


def dedupe_key(df: DataFrame) -> DataFrame:
    """Add acq_ts and the cell that stands in for the near-duplicate radius in the stream."""
    start = F.col("acq_date").cast("timestamp")
    return df.withColumns(
        {
            "acq_ts": F.timestamp_add("MINUTE", F.col("acq_time"), start),
            "cell": GeoGrid(NEAR_DUPLICATE_M / 1000.0).cell_of(F.col("lon"), F.col("lat")),
        }
    )


def fire_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """Deduplicated detections of the CSV files that arrive in a folder, each read by its own header line.

    A file is one task's, which holds a few thousand of its lines at a time.
    """
    # multiLine keeps a file in one split and its lines in order; without separator and quote a line is one value
    reader = spark.readStream.schema("value string").options(multiLine=True, sep=_NO_SEPARATOR, quote="", header=False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.csv(landing).select("value", F.col("_metadata.file_path").alias("file"))
    keyed = dedupe_key(parse_fires(lines_of_files(lines)))
    return keyed.withWatermark("acq_ts", WATERMARK).dropDuplicatesWithinWatermark(["satellite", "acq_ts", "cell"])


_NAMED = ", ".join(f"{c} string" for c in FIRE_CSV_COLUMNS)


def _by_first_line(cells: Iterator[list[str]]) -> Iterator[pa.RecordBatch]:
    """The known columns of every line after the first, by the names in the first, some lines at a time."""
    names = [name.strip().lower() for name in next(cells, [])]
    places = [max((i for i, name in enumerate(names) if name == c), default=len(names)) for c in FIRE_CSV_COLUMNS]
    while some := list(islice(cells, _STEP_LINES)):
        rows = [row[: len(names)] for row in some if row]
        columns = [pa.array([row[i] or None if i < len(row) else None for row in rows], pa.string()) for i in places]
        yield pa.RecordBatch.from_arrays(columns, list(FIRE_CSV_COLUMNS))


def named_lines(files: DataFrame) -> DataFrame:
    """The known columns of every line after a file's first; a row is a whole file."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("value").to_pylist():
                yield from _by_first_line(csv.reader(io.StringIO(text or "")))

    return files.select("value").mapInArrow(task, _NAMED)


def lines_of_files(lines: DataFrame) -> DataFrame:
    """The known columns of every line (value, file) after a file's first; a file is in one partition, its lines in their order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owned = ((file, value or "") for batch in batches for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist(), strict=True))
        for _, own in groupby(owned, key=itemgetter(0)):
            yield from _by_first_line(csv.reader(f"{value}\n" for _, value in own))

    return lines.select("value", "file").mapInArrow(task, _NAMED)


def start_fires(
    spark: SparkSession, landing: str, table: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Append each batch to `table`, one folder per batch: a repeated batch replaces its own folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return (
        fire_stream(spark, landing, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def daily_counts(detections: DataFrame) -> DataFrame:
    """Detections per tumbling day and day/night."""
    return (
        detections.groupBy(F.window("acq_ts", "1 day").alias("w"), "day_night")
        .agg(F.count(F.lit(1)).alias("detections"))
        .select(F.to_date("w.start").alias("day"), "day_night", "detections")
    )
