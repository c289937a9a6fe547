"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a text with up to k = max(1, floor(error_rate * m)) edits. Cut into k + 1 pieces, at least one piece of it then occurs unchanged.
An Aho-Corasick automaton finds all piece hits in a text, each hit names the window in which its item would lie, and
Myers' bit-parallel distance decides, on that window only.

Texts and items are lower-cased and their white space is made single spaces. Items reach the tasks in blocks of at most BLOCK_CHARS
characters, so what is broadcast is bounded however many items there are; every text is scanned once per block.

Items shorter than `min_chars` after normalising have no error budget: they are found as they are, between word bounds.

Cases: null and empty texts match nothing; items that are null or shorter than `least_chars` (a word or two occurs anywhere) are not used; equal items are all reported; repeated rows are judged alike; other columns are carried, never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.llm.common import steps, strings

ERROR_RATE = 0.05
MIN_CHARS = 32
LEAST_CHARS = 12
BLOCK_CHARS = 8_000_000
HITS = "doc_id bigint, item_id bigint, distance int, start_char bigint, end_char bigint"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def best_match(pattern: str, text: str, limit: int) -> tuple[int, int] | None:
    """(distance, end) of the best occurrence of `pattern` in `text` with at most `limit` edits, the first of equals."""
    masks: dict[str, int] = {}
    for i, char in enumerate(pattern):
        masks[char] = masks.get(char, 0) | 1 << i
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, None
    for i, char in enumerate(text):
        eq = masks.get(char, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        more, less = down | (~(xh | up) & full), up & xh
        if more & last:
            score += 1
        elif less & last:
            score -= 1
        more, less = (more << 1) & full, (less << 1) & full
        up, down = less | (~(xv | more) & full), more & xv
        if score <= limit:
            limit, best = score - 1, (score, i + 1)
            if score == 0:
                break
    return best


def _in_word(char: str) -> bool:
    """Whether a letter beside it may belong to the same word: digits and letters of scripts with two cases, which set words apart by spaces."""
    return char.isdigit() or char.upper() != char


def between_bounds(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] begins and ends where a word does."""
    opens = start == 0 or not (_in_word(text[start - 1]) and _in_word(text[start]))
    return opens and (end == len(text) or not (_in_word(text[end - 1]) and _in_word(text[end])))


def pieces(text: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): the text in budget + 1 pieces whose lengths differ by one at most."""
    n = budget + 1
    cuts = [len(text) * i // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Matcher:
    """The pieces of one block of items; those under `min_chars` have a budget of 0."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int):
        self.items = [(item_id, text, max(1, int(error_rate * len(text))) if len(text) >= min_chars else 0) for item_id, text in items]
        owners: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, budget) in enumerate(self.items):
            for offset, piece in pieces(text, budget):
                owners.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each item the starts at which it could lie, joined where their windows overlap: [first start, last start]."""
        starts: dict[int, list[int]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for i, offset in where:
                starts.setdefault(i, []).append(end + 1 - length - offset)
        out = {}
        for i, found in starts.items():
            budget, spans = self.items[i][2], []
            for start in sorted(found):
                if spans and budget and start <= spans[-1][1] + 2 * budget:
                    spans[-1][1] = start
                else:
                    spans.append([start, start])
            out[i] = spans
        return out

    def match(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, end) of the best occurrence of each item that occurs in a normalised text."""
        out = []
        for i, spans in self.windows(text).items():
            item_id, pattern, budget = self.items[i]
            best = None
            for first, last in spans:
                if budget == 0:  # the hit is the whole item
                    if between_bounds(text, first, first + len(pattern)):
                        best = (0, first + len(pattern))
                        break
                    continue
                low, high = max(0, first - budget), min(len(text), last + len(pattern) + budget)
                at = text.find(pattern, low, high)
                found = (0, at + len(pattern)) if at >= 0 else None
                if found is None and high - low >= len(pattern) - budget:
                    found = best_match(pattern, text[low:high], budget if best is None else best[0] - 1)
                    found = found and (found[0], found[1] + low)
                if found and (best is None or found[0] < best[0]):
                    best = found
                if best and best[0] == 0:
                    break
            if best:
                out.append((item_id, best[0], max(0, best[1] - len(pattern)), best[1]))
        return out


def item_blocks(benchmark: DataFrame, least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The usable items, normalised, in blocks of at most `block_chars` characters or one item; one block and one partition of items at a time are on the driver."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("bigint"), "text").where("text is not null").distinct()
    for row in rows.toLocalIterator():
        text = normal(row.text)
        if len(text) < max(least_chars, 1):
            continue
        if block and size + len(text) > block_chars:
            yield sorted(block, key=lambda x: (x[1], x[0] is None, x[0] or 0))
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    if block:
        yield sorted(block, key=lambda x: (x[1], x[0] is None, x[0] or 0))


def matches(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per text and item that occurs in it: doc_id, item_id, distance, and the place in the normalised text.

    The start is the end less the item's length, exact when the distance is 0.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for block in item_blocks(benchmark, least_chars):
        shared = spark.sparkContext.broadcast(block)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate, min_chars)
            for batch in batches:
                for part in steps(batch):
                    found = []
                    for doc_id, text in zip(part.column("doc_id").to_pylist(), strings(part.column("text")), strict=True):
                        found += [(doc_id, *hit) for hit in matcher.match(normal(text))]
                    columns = list(zip(*found, strict=True)) or [()] * 5
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                    names = ["doc_id", "item_id", "distance", "start_char", "end_char"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        part = rows.mapInArrow(task, HITS)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], HITS) if out is None else out


def keep_clean(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_chars: int = MIN_CHARS, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The rows in whose text no item occurs, with all their columns."""
    spark = docs.sparkSession
    for block in item_blocks(benchmark, least_chars):
        shared = spark.sparkContext.broadcast(block)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate, min_chars)
            for batch in batches:
                for part in steps(batch):
                    clean = [not matcher.match(normal(text)) for text in strings(part.column("text"))]
                    yield part.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(task, docs.schema)
    return docs
