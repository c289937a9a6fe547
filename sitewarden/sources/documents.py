"""Elements of large JSON documents, read by many tasks.

Spark splits text at any single character, so a document is read in pieces that end at closing braces, whatever its lines. What a split begins with, inside
a string or at which depth, follows from the splits before it. So there are two passes: the first reduces each split to the change it makes, for either
beginning; those few numbers, one row per split, give every split its beginning. The second cuts out the elements. One that runs over the end
of a split is put together from its parts.

An element is a bracketed value with `level` brackets around it: 1 in a list of objects, 2 in the `features` of a collection. Values of
other members at that depth are elements, too; callers tell them by their fields.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

END = "}"
_MARK = re.compile(r'\\.|["{}\[\]]', re.DOTALL)
_STEP = {"{": 1, "[": 1, "}": -1, "]": -1}
_CHANGE = "file string, start bigint, flips int, deeper0 int, deeper1 int, least0 int, least1 int"
_PARTS = "file string, began bigint, part bigint, text string"


def _pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    text = spark.read.option("lineSep", END).text(list(paths))
    return text.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    """(split, piece) in the order of the file."""
    for batch in batches:
        for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")), strict=True):
            yield (file, start), value + END


def _changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: whether it has an odd number of quotes; the change of depth and the least depth if it begins outside (0) or inside (1) a string."""
    found: dict[tuple[str, int], list[int]] = {}
    for split, piece in _rows(batches):
        change = found.setdefault(split, [0, 0, 0, 0, 0])
        for mark in _MARK.findall(piece):
            if mark == '"':
                change[0] ^= 1
            elif step := _STEP.get(mark):
                # a bracket counts where the quotes so far cancel the beginning
                seen = change[0]
                change[1 + seen] += step
                change[3 + seen] = min(change[3 + seen], change[1 + seen])
    rows = [(*split, *change) for split, change in found.items()]
    if rows:
        kinds = [pa.string(), pa.int64(), *[pa.int32()] * 5]
        names = [c.split()[0] for c in _CHANGE.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def _beginnings(changes: list, level: int) -> dict[tuple[str, int], tuple[int, int, int | None]]:
    """Depth, inside a string (1) or not (0), and the split in which an element began that is open, at the beginning of each split."""
    out, last = {}, None
    for row in sorted(changes, key=lambda r: (r.file, r.start)):
        if row.file != last:
            last, depth, quoted, began = row.file, 0, 0, None
        out[row.file, row.start] = depth, quoted, began
        deeper, least = (row.deeper1, row.least1) if quoted else (row.deeper0, row.least0)
        if depth + deeper <= level:
            began = None
        elif began is None or depth + least <= level:
            began = row.start
        depth, quoted = depth + deeper, quoted ^ row.flips
    return out


def json_elements(spark: SparkSession, paths: str | Sequence[str], level: int = 1) -> DataFrame:
    """(text) of every element of the documents. Documents that are not closed give the elements that are."""
    pieces = _pieces(spark, [paths] if isinstance(paths, str) else paths)
    begins = _beginnings(pieces.mapInArrow(_changes, _CHANGE).collect(), level)  # a row per split

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int, int | None, str]] = []
        size = 0
        split, depth, quoted, began, held = None, 0, 0, None, []

        def close() -> None:
            """The part of an element that goes on in the next split."""
            if split and held:
                rows.append((split[0], began, split[1], "".join(held)))

        def out() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["file", "began", "part", "text"])

        for own, piece in _rows(batches):
            if own != split:
                close()
                split, held = own, []
                depth, quoted, began = begins[own]
            at = 0  # where the open element goes on in this piece
            for mark in _MARK.finditer(piece):
                char = mark.group()
                if char == '"':
                    quoted ^= 1
                elif not quoted and (step := _STEP.get(char)):
                    if step > 0 and depth == level:
                        at, began = mark.start(), split[1]
                    depth += step
                    if step < 0 and depth == level:
                        text = "".join(held) + piece[at : mark.end()]
                        # one that began in an earlier split is completed there
                        rows.append((split[0], began, None if began == split[1] else split[1], text))
                        size += len(text)
                        held, began = [], None
            if depth > level:
                held.append(piece[at:])
            if size > 4_000_000:
                yield out()
                rows, size = [], 0
        close()
        if rows:
            yield out()

    found = pieces.mapInArrow(cut, _PARTS)
    whole = found.where("part is null").select("text")
    parts = found.where("part is not null").groupBy("file", "began").agg(F.sort_array(F.collect_list(F.struct("part", "text"))).alias("parts"))
    return whole.unionByName(parts.select(F.array_join(F.col("parts.text"), "").alias("text")))
