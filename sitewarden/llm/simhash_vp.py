"""Near-duplicates by SimHash, found with vantage-point trees.

A fingerprint has 64 bits. Two fingerprints within `max_bits` differ in at most max_bits // 2 bits in one of their halves. So
each half gets a tree whose vantage points partition it by Hamming distance: inside or outside a ball. A half's distance to a vantage
point and that of a half within r of it differ by r at most (triangle inequality), so a fingerprint is filed in the one shard of its path and
asks in every shard whose region its ball of radius r reaches. On whole fingerprints the ball of radius 3 would overlap
two thirds of the boundaries; on halves with radius 1 it overlaps a quarter, which is what keeps the shards' number of
visitors small. Inside a shard those filed there meet the visitors by exact 64-bit distances, in blocks; a large shard is first
parted by one more tree.

Only distinct fingerprints are filed, so exact copies cost nothing. A shard hands on one edge from each linked fingerprint to the smallest
one of its local group, not all pairs; the groups are joined by connected components over all shards.

The trees are built on the driver from a sample of fingerprints with a fixed bound (SAMPLE_PER_LEAF for each of at most 2**MAX_DEPTH leaves). The
sample sets only where balls lie. Every fingerprint is filed, and results do not depend on it.

Cases: null and empty texts have fingerprint 0 and link like any other; a null doc_id belongs to its component but names none (a
component with null ids only has component_id null); repeated rows stay as they come; other columns are carried, never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewarden.llm.common import steps, utf8
from sitewarden.llm.components import connected
from sitewarden.session import stage

SEED = 42
MAX_BITS = 3
SHINGLE = 3
LEAF = 128
MAX_DEPTH = 15
SAMPLE_PER_LEAF = 32
LARGE_SHARD = 8 * LEAF
CANDIDATES = 6
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 256


def fingerprint_hashes(text: bytes, shingle: int = SHINGLE) -> list[int]:
    """Hashes of the word shingles of a text, repeats included."""
    words = text.translate(_LOWER).split()
    if not words:
        return []
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    digest = xxhash.xxh64_intdigest
    if shingle == 3:
        spaced = [w + b" " for w in words]
        return [digest(a + b + c, SEED) for a, b, c in zip(spaced, spaced[1:], words[2:], strict=False)]
    return [digest(b" ".join(words[i : i + shingle]), SEED) for i in range(len(words) - shingle + 1)]


def fingerprint(hashes: np.ndarray) -> np.uint64:
    """The bits that more than half of the hashes have."""
    if not len(hashes):
        return np.uint64(0)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[start : start + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0]


def fingerprints_of(texts: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    return np.array([fingerprint(np.array(fingerprint_hashes(text, shingle), dtype=np.uint64)) for text in texts], dtype=np.uint64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                prints = fingerprints_of(utf8(part.column("text")), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(task, "doc_id bigint, fp bigint")


def halves(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (prints >> np.uint64(32)).astype(np.uint32), prints.astype(np.uint32)


class Tree:
    """A complete binary tree of vantage points over 32-bit halves; node i has the children 2i + 1 (inside) and 2i + 2."""

    def __init__(self, sample: np.ndarray, depth: int, seed: int = 1):
        self.depth = depth
        inner = (1 << depth) - 1
        self.pivot = np.zeros(inner, dtype=np.uint32)
        self.radius = np.full(inner, 32, dtype=np.int16)
        rng = np.random.default_rng(seed)
        held = {0: sample}
        for node in range(inner):
            values = held.pop(node)
            if len(values):
                best = -1.0
                for pivot in rng.choice(values, CANDIDATES):
                    counts = np.bincount(np.bitwise_count(values ^ pivot), minlength=33)
                    inside = np.cumsum(counts)[:32] / len(values)
                    # even halves, few values next to the border
                    border = (counts[:32] + counts[1:]) / len(values)
                    worth = 4 * inside * (1 - inside) - border / 2
                    if worth.max() > best:
                        best, self.pivot[node], self.radius[node] = worth.max(), pivot, worth.argmax()
            near = np.bitwise_count(values ^ self.pivot[node]) <= self.radius[node]
            held[2 * node + 1], held[2 * node + 2] = values[near], values[~near]

    def home(self, values: np.ndarray) -> np.ndarray:
        """The leaf in which each value is filed."""
        node = np.zeros(len(values), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 2 - (np.bitwise_count(values ^ self.pivot[node]) <= self.radius[node])
        return node - ((1 << self.depth) - 1)

    def reached(self, values: np.ndarray, ball: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the value, leaf) for every leaf whose region the value's ball may overlap."""
        who, node = np.arange(len(values)), np.zeros(len(values), dtype=np.int64)
        for _ in range(self.depth):
            gap = np.bitwise_count(values[who] ^ self.pivot[node]).astype(np.int16) - self.radius[node]
            into, out = gap <= ball, gap > -ball
            who, node = np.concatenate([who[into], who[out]]), np.concatenate([2 * node[into] + 1, 2 * node[out] + 2])
        return who, node - ((1 << self.depth) - 1)


def local_links(filed: np.ndarray, visitors: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (member, smallest) of the groups that the distances between filed and visiting fingerprints make."""
    label = np.arange(len(visitors))
    for start in range(0, len(filed), _BLOCK):
        close = np.bitwise_count(filed[start : start + _BLOCK, None] ^ visitors[None, :]) <= max_bits
        for row in np.flatnonzero(close.sum(axis=1) > 1):
            roots = np.unique(label[close[row]])
            if len(roots) > 1:
                label[np.isin(label, roots)] = roots[0]
    moved = np.flatnonzero(label != np.arange(len(visitors)))
    return visitors[moved], visitors[label[moved]]


def shard_links(filed: np.ndarray, visitors: np.ndarray, half: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """local_links of a shard of the tree over that half; both arrays are sorted.

    A shard that outgrew the trees' greatest depth is parted by a tree of its own, so that its work stays near linear.
    """
    if len(filed) <= LARGE_SHARD:
        return local_links(filed, visitors, max_bits)
    depth = min(MAX_DEPTH, int(np.ceil(np.log2(len(filed) / LEAF))))
    values = halves(filed)[half]
    sample = values[np.linspace(0, len(values) - 1, min(len(values), SAMPLE_PER_LEAF << depth)).astype(np.int64)]
    tree = Tree(sample, depth)
    home = tree.home(values)
    who, leaf = tree.reached(halves(visitors)[half], max_bits // 2)
    order = np.lexsort((who, leaf))
    who, leaf, by_home = who[order], leaf[order], np.argsort(home, kind="stable")
    found = []
    for part in np.unique(home):
        own = by_home[slice(*np.searchsorted(home[by_home], [part, part + 1]))]
        guests = who[slice(*np.searchsorted(leaf, [part, part + 1]))]
        found.append(local_links(filed[own], visitors[guests], max_bits))
    return tuple(np.concatenate(side) for side in zip(*found, strict=True))


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that connect the same groups as all pairs within `max_bits` do."""
    spark = prints.sparkSession
    n = prints.count()
    depth = int(np.clip(np.ceil(np.log2(max(n, 1) / LEAF)), 0, MAX_DEPTH))
    wanted = SAMPLE_PER_LEAF << depth
    share = min(1.0, wanted / max(n, 1))
    picked = prints.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("fp"), "fp").limit(wanted)
    sample = halves(np.array([r.fp for r in picked.collect()], dtype=np.int64).view(np.uint64))
    trees = spark.sparkContext.broadcast([Tree(s, depth) for s in sample])
    ball = max_bits // 2

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                fps = batch.column("fp").slice(start, 4096).to_numpy(zero_copy_only=False)
                for i, (tree, values) in enumerate(zip(trees.value, halves(fps.view(np.uint64)), strict=True)):
                    who, leaf = tree.reached(values, ball)
                    filed = tree.home(values)[who] == leaf
                    yield pa.RecordBatch.from_arrays([pa.array((leaf * 2 + i).astype(np.int32)), pa.array(fps[who]), pa.array(filed)], ["shard", "fp", "filed"])

    def meet(group: pa.Table) -> pa.Table:
        fps = group.column("fp").to_numpy().view(np.uint64)
        order = np.argsort(fps, kind="stable")
        filed = group.column("filed").to_numpy(zero_copy_only=False)[order]
        half = group.column("shard")[0].as_py() % 2
        a, b = shard_links(fps[order][filed], fps[order], half, max_bits)
        return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    shards = prints.select("fp").mapInArrow(file, "shard int, fp bigint, filed boolean")
    return shards.groupBy("shard").applyInArrow(meet, "a bigint, b bigint")


def classes(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) of every row: component_id is the smallest doc_id reachable over links."""
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "prints")
    roots = connected(links(prints, max_bits))
    named = prints.join(roots, prints.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    moved = stage(named.join(least, "root").where("not (first <=> component_id)").select("fp", "component_id"), "moved")
    firsts = prints.join(moved, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return rows.join(firsts, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates: the one with the smallest doc_id. Rows with null doc_id stay.

    Of several rows that share that id one stays.
    """
    found = stage(classes(docs, max_bits, shingle), "classes")
    # written, so that Spark knows its size before it plans the join: a short list is broadcast and no text moves
    gone = stage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    kept = docs.join(gone, docs["doc_id"] == F.col("gone_id"), "left_anti")
    twice = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if twice.isEmpty():
        return kept
    # rows of the ids that came more than once: one of each
    ids = stage(twice.select(F.col("doc_id").alias("twice_id")), "twice")
    once = kept.join(ids, kept["doc_id"] == F.col("twice_id"), "left_anti")
    again = kept.join(ids, kept["doc_id"] == F.col("twice_id"), "left_semi")
    return once.unionByName(again.dropDuplicates(["doc_id"]))
