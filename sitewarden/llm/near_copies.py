"""Near copies for the pipeline: documents whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

Candidates come from SimHash fingerprints of the shingle sets, found within MAX_BITS bits with the vantage-point trees of simhash_vp. These are
the near copies with few edits. No radius that a tree can prune reaches a similarity of 0.8 (about 10 of 64 bits), so the rest is found by
an exact way: a set of n shingles that reaches 0.8 with another shares with it one of the first n // 5 + 1 shingles in any fixed
order (prefix filter). The order puts shingles that are common in a bounded sample last, so that a line in many documents is rarely a
key; the sample sets only the order, and results do not depend on it. Equal sets are one entry, so exact copies cost nothing.

A pair links only if the exact similarity of the whole sets, joined for it, is enough. Before that a bitmap of each set, the parity of its
hashes in each of BITMAP_WORDS x 64 places, drops most pairs: it differs in no more places than the sets have shingles apart, which
are at most a ninth of both. To keep a group of many near copies from meeting in all pairs, each entry is first held against the fingerprints near its
own and at most SPOKES entries that share a key with it. What is then in one component is settled; of the rest every pair of a key
across components is checked. Such a pair leaves the join at its first common key, not at each of them.

Cases: words are as in simhash_vp; texts under five words are one shingle; null and empty texts are equal. Rows are told apart by
(doc_id, text): equal rows fall together, different texts under one id are judged each. Rows with null doc_id stay. Other columns are carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitewarden.llm.common import small, steps, utf8
from sitewarden.llm.components import connected
from sitewarden.llm.simhash_vp import MAX_BITS, fingerprint, fingerprint_hashes, links
from sitewarden.session import stage

SHINGLE = 5
SAMPLE_DOCS = 20_000
SAMPLE_LEAST = 3
MAX_COMMON = 200_000
SPOKES = 4
BEFORE = 16
BITMAP_WORDS = 8
_MAP = [f"m{i}" for i in range(BITMAP_WORDS)]


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text."""
    return np.unique(np.array(fingerprint_hashes(text, SHINGLE), dtype=np.uint64))


def similar(common: int, a: int, b: int) -> bool:
    """Whether sets of a and b elements, `common` of them shared, have a Jaccard similarity of 0.8, in whole numbers."""
    return 9 * common >= 4 * (a + b)


def prefix(hashes: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The keys of a set: its first n // 5 + 1 elements by (count in the sample, hash)."""
    rank = np.zeros(len(hashes), dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        rank = np.where(common[at] == hashes, counts[at], 0)
    return hashes[np.lexsort((hashes, rank))][: len(hashes) // 5 + 1]


def bitmap(hashes: np.ndarray) -> np.ndarray:
    """The parity of the number of hashes in each place, packed to signed 64-bit numbers."""
    places = np.bincount((hashes % np.uint64(64 * BITMAP_WORDS)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(places.astype(np.uint8), bitorder="little").view(np.int64)


def row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text")


def common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of shingles that several documents of a sample share."""
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    picked = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                sets = [shingle_set(t) for t in utf8(part.column("text"))]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["hash"])

    counted = picked.select("text").mapInArrow(task, "hash bigint").groupBy("hash").count().where(F.col("count") >= SAMPLE_LEAST)
    found = counted.orderBy(F.desc("count"), "hash").limit(MAX_COMMON).toArrow()
    hashes, counts = found.column("hash").to_numpy().view(np.uint64), found.column("count").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def set_rows(docs: DataFrame) -> DataFrame:
    """(key, doc_id, sid, n, fp, prefix, m0, ...): each row's key; the hash, size, fingerprint, keys and bitmap of its shingle set."""
    known = docs.sparkSession.sparkContext.broadcast(common_shingles(docs))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch):
                sets = [shingle_set(t) for t in utf8(part.column("text"))]
                sids = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
                heads = [prefix(s, *known.value).view(np.int64) if len(s) else np.zeros(0, dtype=np.int64) for s in sets]
                fps = np.array([fingerprint(s) for s in sets], dtype=np.uint64).view(np.int64)
                maps = np.stack([bitmap(s) for s in sets])
                columns = [part.column("key"), part.column("doc_id"), pa.array(sids), pa.array([len(s) for s in sets], pa.int32()), pa.array(fps), pa.array(heads, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(m) for m in maps.T)], ["key", "doc_id", "sid", "n", "fp", "prefix", *_MAP])

    rows = docs.select(row_key().alias("key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(task, "key bigint, doc_id bigint, sid bigint, n int, fp bigint, prefix array<bigint>, " + ", ".join(f"{m} bigint" for m in _MAP))


def _near_size(a: str, b: str) -> Column:
    return 5 * F.least(a, b) >= 4 * F.greatest(a, b)


def _near_map(a: str, b: str) -> Column:
    """Whether the bitmaps of the sets of sides a and b (prefixes of the columns) allow a similarity of 0.8."""
    apart = reduce(Column.__add__, [F.bit_count(F.col(f"{a}{m}").bitwiseXOR(F.col(f"{b}{m}"))) for m in _MAP])
    return 9 * apart <= F.col(f"{a}n") + F.col(f"{b}n")


def print_pairs(prints: DataFrame) -> DataFrame:
    """Pairs (a, b) of sids: each with the smallest sid of its fingerprint, and those of the fingerprints that the trees link."""
    firsts = stage(prints.groupBy("fp").agg(F.min("sid").alias("first"), F.count(F.lit(1)).alias("sets")), "fingerprints")
    same = prints.join(firsts.where("sets > 1"), "fp").where("sid <> first").select(F.col("first").alias("a"), F.col("sid").alias("b"))
    near = stage(links(firsts.select("fp"), MAX_BITS).distinct(), "links")
    mine, theirs = (firsts.select(F.col("fp").alias(c), F.col("first").alias(f"{c}_first")) for c in "ab")
    found = near.join(mine, "a").join(theirs, "b").select(F.least("a_first", "b_first").alias("a"), F.greatest("a_first", "b_first").alias("b"))
    return same.unionByName(found)


def possible(prints: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs whose sizes and bitmaps allow a similarity of 0.8."""
    mine, theirs = (prints.select(F.col("sid").alias(c), *(F.col(m).alias(f"{c}_{m}") for m in ("n", *_MAP))) for c in "ab")
    return pairs.join(mine, "a").join(theirs, "b").where(_near_size("a_n", "b_n") & _near_map("a_", "b_")).select("a", "b")


def verified(docs: DataFrame, prints: DataFrame, pairs: DataFrame, repeated: bool = True) -> DataFrame:
    """The pairs (a, b) of sids whose sets have a Jaccard similarity of at least 0.8; only the texts of those sets move,
    packed: they are smaller than their hashes, which are made anew where two meet.

    `repeated` tells whether rows of docs may be equal.
    """
    sids = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    wanted = stage(prints.join(sids, "sid").select("key", "sid"), "wanted")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in steps(batch):
                texts = [pack(t) for t in utf8(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("sid"), pa.array(texts, pa.binary())], ["sid", "packed"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in steps(batch, "a_packed"):
                keep = []
                known: tuple[int | None, np.ndarray] = (None, np.zeros(0, dtype=np.uint64))
                columns = (part.column(c).to_pylist() for c in ("b", "a_packed", "b_packed"))
                for b, mine, theirs in zip(*columns, strict=True):
                    if b != known[0]:  # the join puts the pairs of one b together
                        known = b, shingle_set(unpack(theirs))
                    x, y = shingle_set(unpack(mine)), known[1]
                    keep.append(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    texts = docs.select(row_key().alias("key"), "text").join(small(wanted), "key").select("sid", "text")
    held = texts.mapInArrow(packed, "sid bigint, packed binary")
    # equal rows have one key; only where there are some do their texts have to be made one
    held = stage(held.dropDuplicates(["sid"]) if repeated else held, "texts")
    mine, theirs = (held.select(F.col("sid").alias(c), F.col("packed").alias(f"{c}_packed")) for c in "ab")
    return stage(pairs.join(mine, "a").join(theirs, "b").select("a", "b", "a_packed", "b_packed").mapInArrow(check, "a bigint, b bigint"), "verified")


def with_before(entries: DataFrame) -> DataFrame:
    """Add `before`, the BEFORE keys (or fewer) that an entry's set brings just before this one."""
    return entries.withColumn("before", F.collect_list("hash").over(Window.partitionBy("sid").orderBy("pos").rowsBetween(-BEFORE, -1)))


def meetings(still: DataFrame) -> DataFrame:
    """Pairs (a, b) of sids of two components that share a key and whose sizes and bitmaps allow a similarity of 0.8.

    A pair comes at its first shared key; again only where its shared keys are more than BEFORE apart.
    """
    # a pair of two components has a side outside the largest one; if both are, it comes from that of the smaller sid
    left = still.where("label <> largest").select("hash", *(F.col(c).alias(f"my_{c}") for c in ("sid", "n", "pos", "label", "before", *_MAP)))
    once = (F.col("label") == F.col("largest")) | (F.col("my_sid") < F.col("sid"))
    # at the first shared key of two sets no more than the rest of either can be shared
    enough = 9 * F.least(F.col("my_n") - F.col("my_pos"), F.col("n") - F.col("pos")) >= 4 * (F.col("my_n") + F.col("n"))
    both = left.join(still, "hash").where((F.col("my_label") != F.col("label")) & once & _near_size("my_n", "n") & enough & _near_map("my_", ""))
    # an earlier shared key has brought the pair already: it has the same labels there, and more of both sets behind it
    return both.where(~F.arrays_overlap("my_before", "before")).select(F.least("my_sid", "sid").alias("a"), F.greatest("my_sid", "sid").alias("b"))


def set_links(docs: DataFrame, rows: DataFrame, prints: DataFrame, repeated: bool = True) -> DataFrame:
    """(node, root) of the components of sids that all pairs of at least 0.8 connect."""
    # the keys of a set are those of the row that stands for it; equal rows would bring them twice
    heads = rows.join(small(prints.select("key")), "key", "left_semi")
    heads = heads.dropDuplicates(["sid"]) if repeated else heads
    entries = heads.select("sid", "n", F.posexplode("prefix").alias("pos", "hash"))
    of_key = Window.partitionBy("hash")
    spoke = F.struct(F.xxhash64(F.pmod("hash", F.lit(SPOKES)), "sid").alias("order"), "sid", "n")
    shared = entries.withColumns({"low": F.min("sid").over(of_key), "high": F.max("sid").over(of_key), "hub": F.min(spoke).over(of_key)}).where("low < high")
    shared = stage(shared.select("hash", "sid", "n", "pos", F.col("hub.sid").alias("hub"), F.col("hub.n").alias("hub_n")), "shared")
    # the hubs of a spoke have one order, so that a set meets the first of them only
    spoke_of = F.pmod("hash", F.lit(SPOKES)).alias("spoke")
    hubs = shared.where((F.col("sid") != F.col("hub")) & _near_size("n", "hub_n")).groupBy("sid", spoke_of).agg(F.min_by("hub", F.xxhash64(F.pmod("hash", F.lit(SPOKES)), "hub")).alias("hub"))
    tried = hubs.select(F.least("sid", "hub").alias("a"), F.greatest("sid", "hub").alias("b")).unionByName(print_pairs(prints)).distinct()
    tried = stage(possible(prints, tried), "tried")
    found = verified(docs, prints, tried, repeated)
    roots = stage(connected(found), "roots")

    labelled = shared.select("hash", "sid", "n", "pos").join(roots, shared["sid"] == roots["node"], "left").withColumn("label", F.coalesce("root", "sid")).drop("node", "root")
    labelled = stage(labelled, "labelled")
    sizes = labelled.groupBy("hash", "label").count()
    mixed = sizes.groupBy("hash").agg(F.max_by("label", F.struct("count", "label")).alias("largest"), F.count(F.lit(1)).alias("labels")).where("labels > 1").select("hash", "largest")
    still = stage(with_before(labelled.join(mixed, "hash").join(prints.select("sid", *_MAP), "sid")), "still")
    rest = meetings(still).distinct().join(tried, ["a", "b"], "left_anti")
    rest = stage(rest, "rest")
    return roots if rest.isEmpty() else connected(found.unionByName(verified(docs, prints, rest, repeated)))


def free_name(docs: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of docs is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies: the one with the smallest doc_id. Rows with null doc_id stay."""
    gone_key, twice_key = free_name(docs, "gone_key"), free_name(docs, "twice_key")
    rows = stage(set_rows(docs), "set_rows")
    prints = stage(rows.groupBy("sid").agg(F.min("key").alias("key"), *(F.any_value(c).alias(c) for c in ("n", "fp", *_MAP))), "prints")
    repeated = not rows.groupBy("key").count().where("count > 1").isEmpty()
    roots = stage(set_links(docs, rows, prints, repeated), "roots")
    named = rows.where("doc_id is not null").select("key", "doc_id", "sid").join(roots, F.col("sid") == F.col("node"), "left")
    named = stage(named.select("key", "doc_id", F.coalesce("root", "sid").alias("root")), "named")
    least = named.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("least")).select("root", F.col("least.key").alias("least"))
    # written, so that Spark knows its size before it plans the join: a short list is broadcast and no text moves
    gone = stage(named.join(least, "root").where("key <> least").select(F.col("key").alias(gone_key)).distinct(), "gone")
    kept = docs.join(gone, row_key() == F.col(gone_key), "left_anti")
    twice = named.groupBy("key").count().where("count > 1").select(F.col("key").alias(twice_key)).join(gone, F.col(twice_key) == F.col(gone_key), "left_anti")
    twice = stage(twice, "twice")
    if twice.isEmpty():
        return kept
    once = kept.join(twice, row_key() == F.col(twice_key), "left_anti")
    again = kept.join(twice, row_key() == F.col(twice_key), "left_semi")
    return once.unionByName(again.dropDuplicates(["doc_id", "text"]))
