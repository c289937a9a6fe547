"""Audit of filters that interact: what each step of every order of a filter set keeps, removes and repeats.

A document enters with the mask of the filters it fails. A mask decides every step of every order, so each mask is mapped to wide integers, one for each
outcome, whose fields (FIELD_BYTES each) hold that outcome at all steps of all orders: 600 fields for five filters. A part's report is the sum of its
documents' integers, taken apart again at the end. A field's sum is at most the part's number of documents, which a field of 64 bits
holds, so no field runs into the next one.

Documents are counted by (part, mask, labels) before any integer is built, so that a part hands at most 2 ** filters * 4 rows to its sum,
also where it has a third of all documents. Copies are found without a join of texts: rows are counted by the digest of their text, and each
digest's smallest doc_id, one row, is moved from the copies to the others.

Cases: null text is empty; null source and the empty source are one part; rows that share a doc_id count each, and do not make
copies of one another; a row without doc_id is neither a copy nor the original of one; several label rows of a document count if any of them has
the value 1; documents without labels count as neither good nor toxic; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.llm.common import steps, utf8
from sitewarden.session import stage

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # per cent of the words
MOST_CAPITALS = 2  # per cent of the code points
COPY_BIT = 1 << FILTERS.index("E")
FIELD_BYTES = 8
MAX_FILTERS = 6
_ODD_SIGN = re.compile(rb"[#$%&*|]")
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_LATER_BYTES = bytes(range(0x80, 0xC0))  # all bytes of a code point but its first
_STEP_OUTCOMES = ("kept", "removed", "redundant", "unique_fails")
OUTCOMES = (*_STEP_OUTCOMES, "good_lost", "toxic_lost", "shapley")


def orders(filters: str) -> list[str]:
    return ["".join(p) for p in permutations(filters)]


def _pack(fields: list[bool]) -> int:
    return int.from_bytes(np.array(fields, dtype=f"<u{FIELD_BYTES}").tobytes(), "little")


def _unpack(packed: int, n_fields: int) -> np.ndarray:
    return np.frombuffer(packed.to_bytes(FIELD_BYTES * n_fields, "little"), dtype=f"<u{FIELD_BYTES}").astype(np.int64)


@lru_cache(maxsize=4)
def packed_outcomes(filters: str) -> list[dict[str, int]]:
    """For each mask (bit i: filter i fails) and outcome the integer with a field per (order, step)."""
    if not 1 <= len(set(filters)) == len(filters) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} different filters, not {filters!r}")
    table = []
    for mask in range(1 << len(filters)):
        fails = {f: bool(mask >> i & 1) for i, f in enumerate(filters)}
        fields: dict[str, list[bool]] = {name: [] for name in _STEP_OUTCOMES}
        for order in orders(filters):
            gone = False
            for f in order:
                fields["removed"].append(fails[f] and not gone)
                fields["redundant"].append(fails[f] and gone)
                fields["unique_fails"].append(fails[f] and sum(fails.values()) == 1)
                gone = gone or fails[f]
                fields["kept"].append(not gone)
        table.append({name: _pack(values) for name, values in fields.items()})
    return table


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per (part, filter_order, step) from `counts` (part string, mask int, good boolean, toxic boolean, n bigint), a row per combination."""
    packed_outcomes(filters)  # raises here, not in a task
    all_orders = orders(filters)
    n_steps = len(filters)
    n_fields = len(all_orders) * n_steps

    def report(group: pa.Table) -> pa.Table:
        table = packed_outcomes(filters)
        sums = dict.fromkeys((*_STEP_OUTCOMES, "good_lost", "toxic_lost"), 0)
        for row in group.to_pylist():
            for name in _STEP_OUTCOMES:
                sums[name] += row["n"] * table[row["mask"]][name]
            for label, name in (("good", "good_lost"), ("toxic", "toxic_lost")):
                if row[label]:
                    sums[name] += row["n"] * table[row["mask"]]["removed"]
        found = {name: _unpack(total, n_fields) for name, total in sums.items()}
        which = np.array([filters.index(f) for order in all_orders for f in order])
        per_filter = np.zeros(n_steps, dtype=np.int64)
        np.add.at(per_filter, which, found["removed"])
        found["shapley"] = per_filter[which]
        keys = {
            "part": pa.array([group.column("part")[0].as_py()] * n_fields, pa.string()),
            "filter_order": pa.array(np.repeat(all_orders, n_steps).tolist(), pa.string()),
            "step": pa.array(np.tile(np.arange(1, n_steps + 1, dtype=np.int32), len(all_orders))),
        }
        return pa.table(keys | {name: pa.array(found[name]) for name in OUTCOMES})

    schema = "part string, filter_order string, step int, " + ", ".join(f"{name} bigint" for name in OUTCOMES)
    return counts.select("part", "mask", "good", "toxic", "n").groupBy("part").applyInArrow(report, schema)


def text_fails(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    n_chars = len(text.translate(None, _LATER_BYTES))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    fails = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < LEAST_DISTINCT * len(words),
        100 * capitals > MOST_CAPITALS * n_chars,
        _ODD_SIGN.search(text) is not None,
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, part, mask, digest) of (doc_id, part, text)."""
    for batch in batches:
        for rows in steps(batch):
            texts = utf8(rows.column("text"))
            masks = pa.array(list(map(text_fails, texts)), pa.int32())
            digests = pa.array([md5(t, usedforsecurity=False).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("part"), masks, digests], ["doc_id", "part", "mask", "digest"])


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per (part, mask, good, toxic), from their texts, copies among all texts and labels."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "text")
    failed = rows.mapInArrow(masked, "doc_id bigint, part string, mask int, digest binary")
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marked = marked.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    no = F.lit(False)
    labelled = failed.join(marked, "doc_id", "left").withColumn("good", F.coalesce("good", no)).withColumn("toxic", F.coalesce("toxic", no))

    group = ["digest", "part", "mask", "good", "toxic"]
    per_id = labelled.groupBy("doc_id", *group).agg(F.count(F.lit(1)).alias("n"))
    # the smallest id of each group with its number of rows; groups without any id have none
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    groups = per_id.groupBy(*group).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("nameless"), least.alias("least"))
    groups = groups.select(*group, "n", F.coalesce("nameless", F.lit(0)).alias("nameless"), F.col("least.doc_id").alias("first_id"), F.col("least.n").alias("n_first"))
    groups = stage(groups, "text_groups")
    firsts = groups.where("first_id is not null").groupBy("digest").agg(F.min("first_id").alias("first_id"))
    # keyed by digest and id: a text of many parts sends only the groups that hold its smallest id here
    original = groups.join(firsts, ["digest", "first_id"])
    as_copy = (F.col("mask") + COPY_BIT).alias("mask")
    labels_of = ["good", "toxic"]
    moved = groups.select("part", as_copy, *labels_of, (F.col("n") - F.col("nameless")).alias("n"))
    moved = moved.unionByName(groups.where("nameless > 0").select("part", "mask", *labels_of, F.col("nameless").alias("n")))
    moved = moved.unionByName(original.select("part", as_copy, *labels_of, (-F.col("n_first")).alias("n"))).unionByName(original.select("part", "mask", *labels_of, F.col("n_first").alias("n")))
    return moved.groupBy("part", "mask", *labels_of).agg(F.sum("n").alias("n")).where("n > 0")


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five document filters in all 120 orders, per source."""
    return audit(mask_counts(docs, labels))
