"""Token ids of a corpus in rANS-coded files.

Documents are dealt to ranges of doc_id, tokenised in order and written as rows of one binary segment each (see rans.py) by Spark's own writer, so
that a lost executor's files are written again and only complete sets are committed. A segment closes when it has
SEGMENT_TOKENS ids, so a task holds that many and one document at most.

Cases: null and empty texts have no id but the end id; a null doc_id comes first; rows that share a doc_id are ordered by a hash of their
text, equal rows follow each other; an empty table gives a store without segments; other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitewarden.llm.common import steps
from sitewarden.llm.rans import Segment, encode
from sitewarden.llm.token_cache import encoder

END_ID = 2
SEGMENT_TOKENS = 2_000_000
STEP_BYTES = 8_000_000
STORE = "part int, seq int, n_docs bigint, n_tokens bigint, segment binary"


def write_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Tokenise and write. `tokenizer` is the path of a tokenizer file that every executor has."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        words = encoder(tokenizer)
        doc_ids: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0
        end = np.array([end_id], dtype=np.uint32)

        def close() -> pa.RecordBatch:
            lengths = np.array([len(h) for h in held], dtype=np.int64)
            blob = encode(doc_ids, lengths, np.concatenate(held))
            row = [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(doc_ids)]), pa.array([size]), pa.array([blob], pa.binary())]
            doc_ids.clear()
            held.clear()
            return pa.RecordBatch.from_arrays(row, ["part", "seq", "n_docs", "n_tokens", "segment"])

        for batch in batches:
            for piece in steps(batch, limit=STEP_BYTES):
                ids, counts = words.ids(piece.column("text"))
                for doc_id, own in zip(piece.column("doc_id").to_pylist(), np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                    doc_ids.append(doc_id)
                    held.append(np.append(own, end))
                    size += len(own) + 1
                    if size >= SEGMENT_TOKENS:
                        yield close()
                        seq, size = seq + 1, 0
        words.forget()
        if doc_ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, *order[:2]).sortWithinPartitions(*order)
    dealt.mapInArrow(task, STORE).write.option("compression", "none").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    store = spark.read.schema(STORE).parquet(path)
    sizes = store.select("part", "seq", "n_tokens")
    # as many rows as the writer had partitions
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    parts = parts.select("part", before.alias("part_start"))
    inner = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    starts = sizes.withColumn("seq_start", inner).join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("base"))
    return decoded(store).join(starts, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def decoded(store: DataFrame) -> DataFrame:
    """(part, seq, doc_id, offset, n_tokens, ids_crc32): the documents of every segment, decoded."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, blob in zip(batch.column("part").to_pylist(), batch.column("seq").to_pylist(), batch.column("segment").to_pylist(), strict=True):
                segment = Segment(blob)
                ids = segment.blocks().astype("<u4")
                ends = np.cumsum(segment.lengths)
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(ends - segment.lengths, ends, strict=True)]
                n = len(sums)
                columns = [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(segment.doc_ids, pa.int64()), pa.array(ends - segment.lengths), pa.array(segment.lengths), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"])

    return store.select("part", "seq", "segment").mapInArrow(task, "part int, seq int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids): the stored ids themselves."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("segment").to_pylist():
                segment = Segment(blob)
                offsets = np.concatenate([[0], np.cumsum(segment.lengths)]).astype(np.int32)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(segment.blocks().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(segment.doc_ids, pa.int64()), values], ["doc_id", "ids"])

    return spark.read.schema(STORE).parquet(path).select("segment").mapInArrow(task, "doc_id bigint, ids array<int>")
