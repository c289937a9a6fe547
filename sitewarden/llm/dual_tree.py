"""Ranked lexical search: the k best documents of every item, by an exact dual-tree search.

A document's score for an item is the sum over the item's terms, once each, of the term's weight times its impact in the document (whole numbers, a
saturated and length-normalised frequency). So it is a product of two sparse vectors without negative entries, and for a set of items and a
set of documents the product of their coordinate-wise maxima bounds every score between them. Items form a hierarchy of such sets, built once; documents
form one per chunk of a task. A pair of nodes whose bound is under the weakest k-th score among the node's items is dropped with all pairs below it.

Spark does this per partition: one pass writes each document's counts of the items' terms, from which the corpus statistics are summed; a
second pass searches. Each task starts from k-th scores that a sample of documents (SAMPLE rows) really has, raises them as it goes, and hands on
its own k best per item; those are ranked by item and salt, then by item. The sample sets only where the search starts, not what it finds.

The items' terms are held by every task, so items are dealt to blocks of about BLOCK_CHARS code points by a hash, one block a search. No step holds more than one
block of items and one chunk of documents.

Cases: null and empty texts, of items or documents, have no terms and no rows; scores of 0 are no rows; equal scores rank by ascending doc_id, null last;
rows that share a doc_id are ranked each; repeated rows of items give repeated results, several texts of one item_id their own ranks; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitewarden.llm.common import steps, utf8
from sitewarden.session import stage

K = 10
BLOCK_CHARS = 200_000
SAMPLE = 4096
FAN = 8
CHUNK = FAN**4
NODE_CELLS = 2_000_000  # numbers that the finest level of a chunk's hierarchy may hold
SALTS = 64
ITEM_FAN = 4
IMPACT_SCALE = 1_000_000_000
_SLACK = 1 + 1e-9  # bounds are sums of floats
# lower-cases A-Z, blanks out every other ASCII character but letters and digits
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


@dataclass
class Items:
    """A block of items: their terms as numbers of `vocabulary`."""

    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @staticmethod
    def of(texts: list[bytes]) -> Items:
        vocabulary: dict[bytes, int] = {}
        terms = []
        for text in texts:
            held = dict.fromkeys(terms_of(text))
            terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in held], dtype=np.int64))
        return Items(terms, vocabulary)


@dataclass
class ItemNode:
    """Items with the maximum of each coordinate; `terms` are those that are not 0."""

    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    children: list[ItemNode] = field(default_factory=list)


def item_tree(items: Items, weights: np.ndarray) -> ItemNode | None:
    """A hierarchy of the items that have terms. Items that share a heavy term come to lie side by side."""
    ids = [i for i, t in enumerate(items.terms) if len(t)]
    if not ids:
        return None
    holders = np.bincount(np.concatenate([items.terms[i] for i in ids]), minlength=len(weights))
    # the heaviest term that another item has, too
    order = sorted(ids, key=lambda i: (int(max(items.terms[i], key=lambda t: (holders[t] > 1, weights[t]))), i))
    nodes = [ItemNode(np.array([i]), np.sort(items.terms[i]), weights[np.sort(items.terms[i])].astype(np.float64)) for i in order]
    while len(nodes) > 1:
        groups = [nodes[i : i + ITEM_FAN] for i in range(0, len(nodes), ITEM_FAN)]
        nodes = []
        for group in groups:
            held = reduce(np.union1d, [n.terms for n in group])
            nodes.append(ItemNode(np.concatenate([n.items for n in group]), held, weights[held].astype(np.float64), group))
    return nodes[0]


def document_lengths(n_terms: list[int], n_docs: int, total: int) -> np.ndarray:
    """The length factor of each document: 100 at the average length."""
    return np.array([100 - 90 + (90 * n * n_docs) // total for n in n_terms], dtype=np.int64)


class Documents:
    """A chunk of documents: sparse impacts, and the maxima of each coordinate over runs of FAN, FAN ** 2 ... documents."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, impacts: np.ndarray, heavy: np.ndarray, n_terms: int):
        """`first` (one more than documents) are the places of a document's entries; `heavy` the weights that order the documents."""
        n = len(first) - 1
        sizes = np.diff(first)
        owner = np.repeat(np.arange(n), sizes)
        # documents with one heaviest term lie side by side
        worth = heavy[terms] * impacts
        best = np.zeros(n, dtype=np.int64)
        by_worth = np.lexsort((worth, owner))
        has = sizes > 0
        best[has] = terms[by_worth[first[1:][has] - 1]]
        self.order = np.argsort(best, kind="stable")
        place = np.empty(n, dtype=np.int64)
        place[self.order] = np.arange(n)
        moved = np.argsort(place[owner], kind="stable")
        self.terms, self.impacts = terms[moved], impacts[moved]
        self.first = np.concatenate([[0], np.cumsum(sizes[self.order])])
        # level 0 is the coarsest
        self.levels: list[np.ndarray] = []
        nodes = -(-n // FAN)
        finest = np.zeros((n_terms, nodes))
        np.maximum.at(finest, (self.terms, place[owner][moved] // FAN), self.impacts)
        self.levels.append(finest)
        while self.levels[0].shape[1] > 1:
            below = self.levels[0]
            self.levels.insert(0, np.maximum.reduceat(below, np.arange(0, below.shape[1], FAN), axis=1))
        self.n = n

    def scores(self, who: np.ndarray, weight_of: np.ndarray) -> np.ndarray:
        """Exact scores of the documents at these places; `weight_of` has a weight for every term, 0 for those not asked for."""
        sizes = self.first[who + 1] - self.first[who]
        ends = np.cumsum(sizes)
        at = np.repeat(self.first[who] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        each = np.concatenate([[0], np.cumsum(weight_of[self.terms[at]] * self.impacts[at])])
        return each[ends] - each[ends - sizes]


class Search:
    """The k best documents of each item among the chunks given so far."""

    def __init__(self, items: Items, weights: np.ndarray, least: np.ndarray, k: int = K):
        """`least` are scores that k documents of an item are known to reach, at least 1."""
        self.items, self.weights, self.k = items, weights, k
        self.need = np.maximum(least, 1)
        self.tree = item_tree(items, weights)
        self.best: list[list[tuple[int, float, int | None]]] = [[] for _ in items.terms]
        self.visited = 0

    def add(self, docs: Documents, doc_ids: list[int | None]) -> None:
        if self.tree is not None and docs.n:
            self._visit(self.tree, docs, doc_ids, 0, np.arange(1))

    def _visit(self, node: ItemNode, docs: Documents, doc_ids: list[int | None], level: int, runs: np.ndarray) -> None:
        held = docs.levels[level]
        cells = held[node.terms] if len(runs) == held.shape[1] else held[np.ix_(node.terms, runs)]
        self.visited += len(runs)
        bound = (node.weights @ cells) * _SLACK
        likely = bound >= self.need[node.items].min()
        runs, bound = runs[likely], bound[likely]
        if not len(runs):
            return
        if level + 1 < len(docs.levels):
            below = (runs[:, None] * FAN + np.arange(FAN)).ravel()
            below = below[below < docs.levels[level + 1].shape[1]]
            for child in node.children or [node]:
                self._visit(child, docs, doc_ids, level + 1, below)
        elif node.children:
            for child in node.children:
                self._visit(child, docs, doc_ids, level, runs)
        else:
            self._score(node, docs, doc_ids, runs, bound)

    def _score(self, node: ItemNode, docs: Documents, doc_ids: list[int | None], runs: np.ndarray, bound: np.ndarray) -> None:
        """Score the documents of the runs, the most promising first, as long as a run's bound reaches the k-th score."""
        item = int(node.items[0])
        weight_of = np.zeros(len(self.weights), dtype=np.int64)
        weight_of[node.terms] = self.weights[node.terms]
        order = np.argsort(-bound, kind="stable")
        runs, bound = runs[order], bound[order]
        start, width = 0, 4
        while start < len(runs) and bound[start] >= self.need[item]:
            who = (runs[start : start + width, None] * FAN + np.arange(FAN)).ravel()
            who = who[who < docs.n]
            scores = docs.scores(who, weight_of)
            good = scores >= self.need[item]
            found = [(-s, math.inf if (d := doc_ids[docs.order[p]]) is None else d, d) for s, p in zip(scores[good].tolist(), who[good].tolist(), strict=True)]
            if found:
                best = sorted(self.best[item] + found, key=lambda x: x[:2])[: self.k]
                self.best[item] = best
                if len(best) == self.k:
                    self.need[item] = max(self.need[item], -best[-1][0])
            start, width = start + width, 2 * width

    def rows(self) -> pa.RecordBatch:
        found = [(i, d, -s) for i, best in enumerate(self.best) for s, _, d in best]
        columns = list(zip(*found, strict=True)) if found else [(), (), ()]
        types = (pa.int32(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["item", "doc_id", "score"])


def vectors(docs: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with terms: n of any kind, counts of the items' terms."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = shared.value
        known = number_of.keys()
        for batch in batches:
            for part in steps(batch):
                ids, sizes, terms, counts = [], [], [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), strict=True):
                    words = terms_of(text)
                    if not words:
                        continue
                    held = Counter(words)
                    both = known & held.keys()
                    ids.append(doc_id)
                    sizes.append(len(words))
                    terms.append([number_of[t] for t in both])
                    counts.append([held[t] for t in both])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))],
                    ["doc_id", "n", "terms", "counts"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(task, "doc_id bigint, n bigint, terms array<int>, counts array<int>")


def term_weights(held: DataFrame, n_docs: int, n_terms: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) of each term."""
    df = np.zeros(n_terms, dtype=np.int64)
    for row in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the block's vocabulary at most
        df[row.t] = row["count"]
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]].astype(np.int64)


def best_of_tasks(held: DataFrame, items: Items, weights: np.ndarray, least: np.ndarray, n_docs: int, total: int, k: int = K) -> DataFrame:
    """(item, doc_id, score): each task's k best documents of every item that reach `least`."""
    shared = held.sparkSession.sparkContext.broadcast((items, weights, least))
    width = max(1, len(weights))
    chunk = FAN * int(np.clip(NODE_CELLS // width, 1, CHUNK // FAN))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*shared.value, k)
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                first, terms = _lists(part.column("terms"))
                _, counts = _lists(part.column("counts"))
                lengths = document_lengths(part.column("n").to_pylist(), n_docs, total)
                impacts = (IMPACT_SCALE * counts) // (1000 * counts + 8 * np.repeat(lengths, np.diff(first)))
                search.add(Documents(first, terms, impacts, shared.value[1], width), part.column("doc_id").to_pylist())
        yield search.rows()

    return held.select("doc_id", "n", "terms", "counts").mapInArrow(task, "item int, doc_id bigint, score bigint")


def ranked(found: DataFrame, k: int = K) -> DataFrame:
    """The k best rows of each item with their rank, by salts first."""
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]

    def first(rows: DataFrame, *keys: str | Column) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where(F.col("rank") <= k)

    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    return first(first(salted, "item", "salt").drop("rank", "salt"), "item")


def search_block(docs: DataFrame, items: Items, k: int = K) -> DataFrame:
    """(item, rank, doc_id, score) of one block of items, by their number."""
    held = stage(vectors(docs, items), "term_counts")
    size = held.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total")).first()
    n_docs, total = size.docs, size.total or 1
    weights = term_weights(held, n_docs, len(items.vocabulary))
    least = np.zeros(len(items.terms), dtype=np.int64)
    share = max(1, n_docs // SAMPLE)
    sample = held.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(share)) == 0).limit(SAMPLE)
    # at most k rows of each item of the block
    for row in ranked(best_of_tasks(sample, items, weights, least, n_docs, total, k), k).where(F.col("rank") == k).select("item", "score").collect():
        least[row.item] = row.score
    return ranked(best_of_tasks(held, items, weights, least, n_docs, total, k), k).select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents with a score above 0 of each row of `items` (item_id, text)."""
    spark = docs.sparkSession
    distinct = stage(items.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies")), "items")
    chars = distinct.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-chars // block_chars))
    found = []
    for block in range(n_blocks):
        rows = distinct.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block).collect()
        if not rows and block + 1 < n_blocks:
            continue
        held = Items.of([(r.text or "").encode() for r in rows])
        named = spark.createDataFrame([(i, r.item_id, r.copies) for i, r in enumerate(rows)], _named(items))
        result = search_block(docs, held, k).join(F.broadcast(named), "item")
        result = result.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies"))).select("item_id", "rank", "doc_id", "score")
        # one block at a time: its rows are written before the next block is read
        found.append(stage(result, "ranked") if n_blocks > 1 else result)
    return reduce(DataFrame.unionByName, found)


def _named(items: DataFrame) -> str:
    return f"item int, item_id {items.schema['item_id'].dataType.simpleString()}, copies bigint"
