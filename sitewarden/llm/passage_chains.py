"""Substring dedup by collinear chaining of word k-mers: finds passages that occur, almost word for word, in several documents.

Every window of K words is a seed. A key of at most MEET places joins all of them, each with the earlier ones in other documents. The places of a
key of more meet its first one, and are joined again by the key and the next one in the document, K to K + 2 words on (REST), and where that
is not rare either, by three: from LEAST_CHAIN words on any partner makes a chain. So a line that a third of all documents share costs a few
rows per document, never pairs, and hides no passage of which it is a part. Seeds travel packed, a
block per flush and bucket of keys, and so do matches, a block per bucket of keys and of documents.

The matches of two documents are first folded into runs on one diagonal, then chained: a run may follow another that ends before it in both
documents, at a cost of GAP per word skipped on either side; a Fenwick tree over the other document's positions gives the best predecessor. With GAP = 2
a gap on both sides is bridged only at a similarity of about 0.8, one on a single side down to about 0.67. Chains are aligned on the words
themselves: extended at both ends, and held against MIN_SIMILARITY by the longest common subsequence (bit-parallel). A chain that fails is cut at
its costliest gap until each part passes or is under LEAST_CHAIN. Accepted chains that touch in a document make a span; chains of spans of
at least MIN_WORDS words are returned. Pieces of one passage may be matched with different documents; the span joins them again. A document whose
runs all lie within runs with one other document is not reported beside it (`needed`).

Cases: null and empty texts, and texts under K words, have no seeds; a null doc_id cannot be named and is left out; of several texts with one
doc_id the one with the smallest hash is used; equal texts under different ids match as a whole, each with one other; repeats inside one document
are not reported; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import itertools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sitewarden.llm.common import steps, utf8
from sitewarden.session import new_path, stage

K = 5
MEET = 16  # places of a key that all meet one another
GAP = 2.0
MIN_WORDS = 50
LEAST_CHAIN = 12
MIN_SIMILARITY = 0.8
REST = (K, K + 1, K + 2)  # from a seed to the next one of a longer key: none, one or two words lie between
FOLD = 40  # words between two seeds of one run: the words themselves are compared later
REACH = 23  # words by which a passage may go on beyond its outermost seeds
FLUSH_SEEDS = 2_000_000
BUCKET_SEEDS = 1_000_000
FLUSH_CHAINS = 20_000
BYTES_A_WORD = 6
MAX_BUCKETS = 1 << 16
REGION = 4096  # words of a document whose windows are cut in one go
STEP_BYTES = 4_000_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_XXH64 = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def word_hashes(words: pa.StringArray) -> np.ndarray:
    """XXH64 (seed 0) of each word, in whole columns: steps of 8, 4 and 1 bytes; words of 32 bytes and more one by one."""
    p1, p2, p3, p4, p5 = _XXH64
    offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = bytes(words.buffers()[2] or b"") + bytes(8)
    begins, sizes = offsets[:-1], np.diff(offsets)
    eights, fours, ones = (np.ndarray(len(data) - 7, dtype=kind, buffer=data, strides=(1,)) for kind in ("<u8", "<u4", "u1"))
    h = sizes.astype(np.uint64) + p5
    for i in range(3):
        at = np.flatnonzero(sizes >= 8 * i + 8)
        h[at] = _turned(h[at] ^ (_turned(eights[begins[at] + 8 * i] * p2, 31) * p1), 27) * p1 + p4
    at = np.flatnonzero(sizes & 4)
    h[at] = _turned(h[at] ^ (fours[begins[at] + (sizes[at] & ~7)].astype(np.uint64) * p1), 23) * p2 + p3
    for i in range(3):
        at = np.flatnonzero((sizes & 3) > i)
        h[at] = _turned(h[at] ^ (ones[begins[at] + (sizes[at] & ~3) + i].astype(np.uint64) * p5), 11) * p1
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(sizes >= 32).tolist():
        h[i] = xxhash.xxh64_intdigest(data[offsets[i] : offsets[i + 1]])
    return h


def word_codes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts behind one another, number of words of each text); the words are those of words_of."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = split.flatten()
    full = pc.binary_length(words).to_numpy() > 0  # blanks at the ends of a text leave empty words
    before = np.concatenate([[0], np.cumsum(full)])
    parts = split.value_lengths().to_numpy()
    ends = np.cumsum(parts)
    return word_hashes(words)[full], before[ends] - before[ends - parts]


def seeds_of(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, positions, positions of their last K words, index of the text) of all windows of K words of the texts.

    The texts lie behind one another, so that a short one costs no numpy calls of its own; windows over two texts are left out.
    """
    ends = np.cumsum(sizes)
    n = max(0, len(codes) - K + 1)
    mixed = np.zeros(n, dtype=np.uint64)
    for i in range(K):
        mixed += codes[i : i + n] * _ODD[i]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _ODD[0]
    text = np.repeat(np.arange(len(sizes)), sizes)[:n]
    at = np.flatnonzero(np.arange(n) + K <= ends[text])
    text = text[at]
    pos = (at - (ends - sizes)[text]).astype(np.int32)
    return mixed[at], pos, pos, text


def neighbours(codes: np.ndarray, sizes: np.ndarray, pos: np.ndarray, text: np.ndarray) -> np.ndarray:
    """4 bits each of the second to fifth word before (low 16 bits) and after each seed, 0 beyond the text."""
    begins, size = (np.cumsum(sizes) - sizes)[text], sizes[text]
    bits = (codes >> np.uint64(60)).astype(np.uint32)
    out = np.zeros(len(pos), dtype=np.uint32)
    for i in range(4):
        for at, half in ((pos - 2 - i, 0), (pos + K + 1 + i, 16)):
            inside = (at >= 0) & (at < size)
            out |= np.where(inside, bits[begins + np.where(inside, at, 0)], np.uint32(0)) << np.uint32(4 * i + half)
    return out


def equal_sides(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which neighbours of two seeds may be equal: bits 0 to 3 those before, from near to far, bits 4 to 7 those after."""
    differ = a ^ b
    return sum(((differ >> np.uint32(4 * i) & np.uint32(15)) == 0).astype(np.uint8) << np.uint8(i) for i in range(8))


def _ways(bits: int) -> list[tuple[int, int]]:
    """(words, equal ones less K - 1 times those that differ) of the ways to go on from a run by its 4 bits of equal_sides; the next word differs.

    The two texts share no other run of K words there, so a word that differs comes with at most K - 1 equal ones.
    """
    out, value, tail = [(0, 0)], 1 - K, 0
    for i in range(4):
        tail = tail + 1 if bits >> i & 1 else 0
        value += 1 if tail else 1 - K
        if tail:
            out.append((i + 2, value))
    return [*out, (REACH, value + K - 1 - tail)]


def _goes_on(n: int, bits: int) -> bool:
    """Whether a run of n equal words may be part of LEAST_CHAIN words of MIN_SIMILARITY: K - 1 equal words for each that differs."""
    return any(n + x + y >= LEAST_CHAIN and n + v + w >= 0 for x, v in _ways(bits & 15) for y, w in _ways(bits >> 4))


GOES_ON = np.array([[_goes_on(n, bits) for bits in range(256)] for n in range(LEAST_CHAIN + 1)])
GOES_TO = np.array([[max(x for x, v in _ways(bits) if n + v >= 0) for bits in range(16)] for n in range(LEAST_CHAIN + 1)])


def pack(values: np.ndarray) -> bytes:
    """The differences of whole numbers, byte by byte, compressed."""
    steps_of = np.diff(values, prepend=values.dtype.type(0))
    return pa.compress(np.ascontiguousarray(steps_of.view(np.uint8).reshape(len(values), -1).T), codec="zstd", asbytes=True)


def unpack(blocks: list[bytes], sizes: list[int], kind: type) -> np.ndarray:
    """The numbers of packed blocks behind one another."""
    width = np.dtype(kind).itemsize
    out = [np.zeros(0, dtype=kind)]
    for block, n in zip(blocks, sizes, strict=True):
        planes = np.frombuffer(pa.decompress(block, n * width, codec="zstd"), dtype=np.uint8).reshape(width, n)
        out.append(np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind))
    return np.concatenate(out)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)).astype(np.uint16)


def _by_bucket(buckets: np.ndarray, order: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its part of the order), the order being one by bucket first."""
    cut = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cut) if len(order) else ():
        yield int(buckets[part[0]]), part


SEEDS = "bucket int, n int, keys binary, docs binary, pos binary, lasts binary, near binary"


def packed_seeds(keys: np.ndarray, docs: np.ndarray, pos: np.ndarray, last: np.ndarray, near: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket of keys. Its seeds are in the order given; of a key 40 bits are kept besides its bucket: words are compared later."""
    of = _bucket(keys, buckets)
    rows = []
    for bucket, at in _by_bucket(of, np.argsort(of, kind="stable")):
        bits = np.ascontiguousarray(keys[at].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5])
        rows.append((bucket, len(at), bits.tobytes(), pack(docs[at]), pack(pos[at]), pack((last - pos)[at].astype(np.int8)), near[at].tobytes()))
    return _record_batch(rows, SEEDS)


def unpacked_seeds(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, docs, pos, last, near) of the seeds of a bucket."""
    n, keys, docs, pos, lasts, near = _columns(batches, "n", "keys", "docs", "pos", "lasts", "near")
    bits = np.zeros((sum(n), 8), dtype=np.uint8)
    bits[:, :5] = np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(-1, 5)
    places = unpack(pos, n, np.int32)
    return bits.view("<u8").ravel(), unpack(docs, n, np.int64), places, places + unpack(lasts, n, np.int8), np.frombuffer(b"".join(near), dtype=np.uint32)


def _columns(batches: Iterator[pa.RecordBatch], *names: str) -> list[list]:
    out: list[list] = [[] for _ in names]
    for batch in batches:
        for column, name in zip(out, names, strict=True):
            column += batch.column(name).to_pylist()
    return out


_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _record_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [c.split() for c in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], [name for name, _ in fields])


def seed_places(docs: DataFrame, buckets: int) -> DataFrame:
    """All seeds of the documents, packed by bucket of their keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            for part in steps(batch):
                codes, sizes = word_codes(part.column("text"))
                hashes, pos, last, text = seeds_of(codes, sizes)
                if len(hashes):
                    held.append((hashes, part.column("doc_id").to_numpy()[text], pos, last, neighbours(codes, sizes, pos, text)))
                    size += len(hashes)
                if size > FLUSH_SEEDS:
                    yield packed_seeds(*(np.concatenate(c) for c in zip(*held, strict=True)), buckets)
                    held, size = [], 0
        if held:
            yield packed_seeds(*(np.concatenate(c) for c in zip(*held, strict=True)), buckets)

    return docs.select("doc_id", "text").mapInArrow(task, SEEDS)


def met(keys: np.ndarray, docs: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(indexes of places, indexes of the earlier places they meet, indexes of the places of keys of more than MEET places, of those the first one).

    Keys of one document only join nothing.
    """
    order = np.argsort(keys)
    equal = keys[order][1:] == keys[order][:-1]
    order = order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])] if len(order) else order
    order = order[np.lexsort((pos[order], docs[order], keys[order]))]
    k, d = keys[order], docs[order]
    begins = np.concatenate([[True], k[1:] != k[:-1]])[: len(k)]
    group = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    size = np.bincount(group, minlength=len(starts))
    first = starts[group]
    many = (size > MEET)[group]
    later = np.flatnonzero(many & (d != d[first]))
    mine, theirs = [later], [first[later]]
    for step in range(1, min(MEET, len(k))):
        at = np.flatnonzero(~many[step:] & (group[step:] == group[:-step]) & (d[step:] != d[:-step])) + step
        mine.append(at)
        theirs.append(at - step)
    shared = np.flatnonzero(many & (d[starts] != d[starts + size - 1])[group])
    return order[np.concatenate(mine)], order[np.concatenate(theirs)], order[shared], order[first[shared]]


MATCHES = "bucket int, many boolean, n int, docs binary, pos binary, others binary, other_pos binary, keys binary, lasts binary"


def packed_matches(docs: np.ndarray, pos: np.ndarray, others: np.ndarray, other_pos: np.ndarray, keys: np.ndarray, last: np.ndarray | None, buckets: int) -> pa.RecordBatch:
    """One row per bucket of documents. With last: places of keys of many places and these keys; otherwise the keys are the equal_sides of matches."""
    of = _bucket(docs.view(np.uint64) * _ODD[0], buckets)
    rows = []
    for bucket, at in _by_bucket(of, np.lexsort((pos, others, docs, of))):
        d, p = docs[at], pos[at]
        ends = (pack(keys[at]), None) if last is None else (keys[at].tobytes(), pack((last[at] - p).astype(np.int8)))
        rows.append((bucket, last is not None, len(at), pack(d), pack(p), pack(others[at] - d), pack(other_pos[at] - p), *ends))
    return _record_batch(rows, MATCHES)


def unpacked_matches(batches: Iterator[pa.RecordBatch], many: bool) -> tuple[np.ndarray, ...]:
    """(docs, pos, others, other_pos, sides) of a bucket of documents, or (docs, pos, others, other_pos, keys, last) of the places of many."""
    n, docs, pos, others, other_pos, keys, lasts = _columns(batches, "n", "docs", "pos", "others", "other_pos", "keys", "lasts")
    d, p = unpack(docs, n, np.int64), unpack(pos, n, np.int32)
    ends = (np.frombuffer(b"".join(keys), dtype=np.uint64), p + unpack(lasts, n, np.int8)) if many else (unpack(keys, n, np.uint8),)
    return d, p, d + unpack(others, n, np.int64), p + unpack(other_pos, n, np.int32), *ends


def seed_matches(seeds: DataFrame, buckets: int, doc_buckets: int) -> DataFrame:
    """The matches of the seeds of each key, and the places of keys of many places with the first of them, packed by bucket of documents."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, pos, last, near = unpacked_seeds(batches)
        mine, theirs, many, first = met(keys, docs, pos)
        sides = equal_sides(near[mine], near[theirs])
        longer = np.flatnonzero(last[mine] > pos[mine])
        m, t = np.concatenate([mine, mine[longer]]), np.concatenate([theirs, theirs[longer]])
        at, other_at = np.concatenate([pos[mine], last[mine[longer]]]), np.concatenate([pos[theirs], last[theirs[longer]]])
        yield packed_matches(docs[m], at, docs[t], other_at, np.concatenate([sides, sides[longer]]), None, doc_buckets)
        yield packed_matches(docs[many], pos[many], docs[first], pos[first], keys[many], last[many], doc_buckets)

    return seeds.repartitionById(buckets, "bucket").mapInArrow(task, MATCHES)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = ((a ^ (a >> np.uint64(29))) * _ODD[1] + b) * _ODD[2]
    return mixed ^ (mixed >> np.uint64(32))


def _places(docs: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """A number for each place, rising with documents and positions, which are in order."""
    return (np.cumsum(np.concatenate([[0], np.diff(docs) != 0]))[: len(docs)].astype(np.int64) << 32) + pos


def longer_keys(docs: np.ndarray, pos: np.ndarray, others: np.ndarray, other_pos: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, docs, pos, last): the keys of two seeds of many places that follow each other in a document.

    Inside a run of equal words with the first document its own chain is found and the first document's places stand for its
    places, so those over max(REST) from both ends of the run are left out.
    """
    order = np.lexsort((pos, docs))
    docs, pos, others, other_pos, keys = (c[order] for c in (docs, pos, others, other_pos, keys))
    n = len(docs)
    breaks = (np.diff(docs) != 0) | (np.diff(others) != 0) | (np.diff(pos) != 1) | (np.diff(other_pos) != 1) if n else np.zeros(0, dtype=bool)
    run = np.concatenate([[0], np.cumsum(breaks)])[:n]
    starts = np.concatenate([[0], np.flatnonzero(breaks) + 1])
    ends = np.concatenate([starts[1:], [n]])
    at = np.arange(n)
    inside = (others != docs) & (at - starts[run] > max(REST)) & (ends[run] - 1 - at > max(REST))
    docs, pos, keys = docs[~inside], pos[~inside], keys[~inside]
    place = _places(docs, pos)
    found = []
    for step in REST:
        to = np.minimum(np.searchsorted(place, place + step), max(0, len(place) - 1))
        at = np.flatnonzero(place[to] == place + step)
        found.append((_mixed(keys[at], keys[to[at]]), docs[at], pos[at], pos[at] + np.int32(step)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def longest_keys(docs: np.ndarray, pos: np.ndarray, keys: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(keys, docs, pos, last): the keys of three seeds, from two longer keys of many places of which one begins with the other's last seed."""
    order = np.lexsort((pos, docs))
    docs, pos, keys, last = (c[order] for c in (docs, pos, keys, last))
    place = _places(docs, pos)
    low, high = np.searchsorted(place, place - pos + last), np.searchsorted(place, place - pos + last, side="right")
    found = [(keys[:0], docs[:0], pos[:0], last[:0])]
    for i in range(int((high - low).max(initial=0))):
        at = np.flatnonzero(low + i < high)
        to = low[at] + i
        found.append((_mixed(keys[at], keys[to]), docs[at], pos[at], last[to]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def longer_seeds(matches: DataFrame, buckets: int, doc_buckets: int, longest: bool) -> DataFrame:
    """The seeds of longer keys of each document, of two seeds or of three, packed by bucket of their keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, pos, others, other_pos, keys, last = unpacked_matches(batches, True)
        keys, docs, pos, last = longest_keys(docs, pos, keys, last) if longest else longer_keys(docs, pos, others, other_pos, keys)
        order = np.lexsort((pos, docs))
        for part in np.array_split(order, 1 + len(order) // FLUSH_SEEDS):
            yield packed_seeds(keys[part], docs[part], pos[part], last[part], np.zeros(len(part), dtype=np.uint32), buckets)

    return matches.where("many").repartitionById(doc_buckets, "bucket").mapInArrow(task, SEEDS)


def runs(pos: np.ndarray, other: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, other start, other end) of matches on one diagonal at most FOLD words apart."""
    order = np.lexsort((pos, other - pos))
    p, o = pos[order].astype(np.int64), other[order].astype(np.int64)
    cut = np.flatnonzero((np.diff(o - p) != 0) | (np.diff(p) > FOLD)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(p)]]) - 1
    return sorted(zip(p[first].tolist(), (p[last] + K).tolist(), o[first].tolist(), (o[last] + K).tolist(), strict=True))


class Fenwick:
    """Prefix maxima of (value, index)."""

    def __init__(self, n: int):
        self.best = [(-1.0, -1)] * (n + 1)

    def put(self, at: int, value: float, index: int) -> None:
        at += 1
        while at < len(self.best):
            if value > self.best[at][0]:
                self.best[at] = (value, index)
            at += at & -at

    def up_to(self, at: int) -> tuple[float, int]:
        """The best of places before `at`."""
        out = (-1.0, -1)
        while at > 0:
            if self.best[at][0] > out[0]:
                out = self.best[at]
            at -= at & -at
        return out


def chains(segments: list[tuple[int, int, int, int]], gap: float = GAP) -> list[tuple[int, int, int, int]]:
    """Collinear chains of runs as (start, end, other start, other end), best first; every run is in one chain."""
    return [(c[0][0], c[-1][1], c[0][2], c[-1][3]) for c in chained_runs(segments, gap)]


def chained_runs(segments: list[tuple[int, int, int, int]], gap: float = GAP) -> list[list[tuple[int, int, int, int]]]:
    """The runs of each chain, in order."""
    if len(segments) == 1:
        return [segments]
    ends = sorted({s[3] for s in segments})
    rank = {e: i for i, e in enumerate(ends)}
    tree = Fenwick(len(ends))
    score, before = [0.0] * len(segments), [-1] * len(segments)
    waiting = sorted(range(len(segments)), key=lambda i: segments[i][1])
    done = 0
    for i, (start, end, other_start, _) in enumerate(segments):
        while done < len(waiting) and segments[waiting[done]][1] <= start:
            j = waiting[done]
            # runs end after they start, so j has its score already
            tree.put(rank[segments[j][3]], score[j] + gap * (segments[j][1] + segments[j][3]), j)
            done += 1
        low, high = 0, len(ends)
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if ends[middle] <= other_start else (low, middle)
        value, j = tree.up_to(low)
        value -= gap * (start + other_start)
        score[i] = end - start + max(0.0, value)
        before[i] = j if value > 0 else -1
    used, out = [False] * len(segments), []
    for i in sorted(range(len(segments)), key=lambda i: (-score[i], i)):
        if not used[i]:
            at, members = i, []
            while True:
                used[at] = True
                members.append(segments[at])
                if before[at] < 0 or used[before[at]]:
                    break
                at = before[at]
            out.append(members[::-1])
    return out


CHAIN = "doc bigint, other bigint, s int, e int, os int, oe int, runs array<int>"


def needed(docs: np.ndarray, pos: np.ndarray, others: np.ndarray, other_pos: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which matches can make chains that others of their document do not make, and by how many words at most such a chain goes on before and after.

    The equal words of two documents on one diagonal are runs. Two documents with a single run under LEAST_CHAIN words, whose neighbours differ too
    much (GOES_ON), make no chain. Another document is not needed either if runs of at least LEAST_CHAIN words with a third one, on one
    diagonal, hold all its runs.
    """
    if not len(docs):
        return np.zeros(0, dtype=bool), np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    shift = other_pos - pos
    order = np.lexsort((pos, shift, others, docs))
    d, o, q, p, side = docs[order], others[order], shift[order], pos[order].astype(np.int64), sides[order]
    apart = (np.diff(d) != 0) | (np.diff(o) != 0)
    ends_here = apart | (np.diff(q) != 0) | (np.diff(p) > 1)
    first, last = np.concatenate([[0], np.flatnonzero(ends_here) + 1]), np.concatenate([np.flatnonzero(ends_here), [len(p) - 1]])
    pair = np.concatenate([[0], np.cumsum(apart)])
    start, end, o, q, of = p[first], p[last] + K, o[first], q[first], pair[first]
    document = np.concatenate([[0], np.cumsum(np.diff(d) != 0)])[first]
    words = np.minimum(end - start, LEAST_CHAIN)
    goes_on = GOES_ON[words, (side[first] & 15) | (side[last] & 240)]
    free = np.bincount(of) > 1
    single = ~free
    before_by, after_by = np.full(len(free), REACH), np.full(len(free), REACH)
    at = np.flatnonzero(single[of] & (words < LEAST_CHAIN))
    before_by[of[at]], after_by[of[at]] = GOES_TO[words[at], side[first[at]] & 15], GOES_TO[words[at], side[last[at]] >> 4]
    free[of[goes_on]] = True
    # runs of one document after those of another: what reaches farthest before a run is of its own document or short of it
    far = document * (1 << 32)
    by = np.lexsort((q, o, -end, start, document))
    start, end, o, q, of = (start + far)[by], (end + far)[by], o[by], q[by], of[by]
    best = np.maximum.accumulate(np.where(end - start >= LEAST_CHAIN, end, -1))
    holder = np.maximum.accumulate(np.where(np.concatenate([[True], best[1:] > best[:-1]]), np.arange(len(best)), 0))
    before = np.concatenate([[0], holder[:-1]])
    held = np.concatenate([[False], best[:-1] >= end[1:]])
    one = np.zeros(len(free), dtype=np.int64)
    one[of] = before  # any of them: the others have to be of its document and diagonal
    not_held = np.zeros(len(free), dtype=bool)
    not_held[of[~held | (o[before] != o[one[of]]) | (q[before] != q[one[of]]) | (o[before] == o)]] = True
    out = np.zeros(len(docs), dtype=bool)
    out[order] = (free & not_held)[pair]
    by_before, by_after = np.empty(len(docs), dtype=int), np.empty(len(docs), dtype=int)
    by_before[order], by_after[order] = before_by[pair], after_by[pair]
    return out, by_before, by_after


def candidate_chains(matches: DataFrame, doc_buckets: int) -> DataFrame:
    """Chains that may be part of a span of MIN_WORDS words, allowing REACH words beyond each end, or fewer beyond a single short run."""

    def of_doc(doc: int, other: np.ndarray, pos: np.ndarray, other_pos: np.ndarray, before: np.ndarray, after: np.ndarray) -> list[tuple]:
        found = []
        cut = np.flatnonzero(np.diff(other)) + 1
        for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(other)]]), strict=True):
            for members in chained_runs(runs(pos[a:b], other_pos[a:b])):
                s, e, os, oe = members[0][0], members[-1][1], members[0][2], members[-1][3]
                found.append((s - int(before[a]), e + int(after[a]), (doc, int(other[a]), s, e, os, oe, [x for run in members for x in run])))
        found.sort()
        out, group, low, high = [], [], 0, -1
        for s, e, chain in found:
            if group and s > high + 1:
                if high - low >= MIN_WORDS:
                    out += group
                group = []
            if not group:
                low, high = s, e
            group.append(chain)
            high = max(high, e)
        return out + group if group and high - low >= MIN_WORDS else out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc, pos, other, other_pos, sides = unpacked_matches(batches, False)
        keep, before, after = needed(doc, pos, other, other_pos, sides)
        doc, pos, other, other_pos, before, after = (c[keep] for c in (doc, pos, other, other_pos, before, after))
        order = np.lexsort((pos, other, doc))
        doc, pos, other, other_pos, before, after = (c[order] for c in (doc, pos, other, other_pos, before, after))
        found: list[tuple] = []
        cut = np.flatnonzero(np.diff(doc)) + 1
        for a, b in zip(np.concatenate([[0], cut]), np.concatenate([cut, [len(doc)]]), strict=True):
            if b > a:
                found += of_doc(int(doc[a]), *(c[a:b] for c in (other, pos, other_pos, before, after)))
            if len(found) > FLUSH_CHAINS:
                yield _record_batch(found, CHAIN)
                found = []
        yield _record_batch(found, CHAIN)

    return matches.where("not many").repartitionById(doc_buckets, "bucket").mapInArrow(task, CHAIN)


def leading(a: list, b: list) -> int:
    """How many words are equal before the first that differ, or before one list ends."""
    return next(itertools.compress(itertools.count(), map(operator.ne, a, b)), min(len(a), len(b)))


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, by whole-number bit operations between the equal words at both ends."""
    head = leading(a, b)
    a, b = a[head:], b[head:]
    tail = leading(a[::-1], b[::-1])
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    masks: dict = {}
    for i, word in enumerate(a):
        masks[word] = masks.get(word, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        hit = row & masks.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return head + tail + len(a) - row.bit_count()


def extend(a: list, b: list) -> int:
    """How many leading words of both lists belong to the passage: +1 a match, -1 a mismatch, until 3 below the best."""
    score = best = length = 0
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        score += 1 if x == y else -1
        if score > best:
            best, length = score, i + 1
        elif score < best - 3:
            break
    return length


def align(mine: list, theirs: list, chain: tuple[int, int, int, int]) -> tuple[int, int, int, int, float]:
    """Extend a chain (positions in the two lists) at both ends; its new bounds and its similarity."""
    s, e, os, oe = chain
    right = extend(mine[e:], theirs[oe:])
    left = extend(mine[:s][::-1], theirs[:os][::-1])
    s, e, os, oe = s - left, e + right, os - left, oe + right
    similarity = common_length(mine[s:e], theirs[os:oe]) / max(e - s, oe - os, 1)
    return s, e, os, oe, similarity


def equal_blocks(mine: list, theirs: list, members: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The runs without the places where their words differ."""
    out = []
    for s, e, os, _ in members:
        start = None
        for i in range(e - s + 1):
            same = i < e - s and mine[s + i] == theirs[os + i]
            if same and start is None:
                start = i
            elif not same and start is not None:
                out.append((s + start, s + i, os + start, os + i))
                start = None
    return out


def aligned_parts(mine: list, theirs: list, members: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int, float]]:
    """The chain of runs aligned; while a part is under MIN_SIMILARITY, it is cut at its costliest gap and its halves are aligned."""
    whole = align(mine, theirs, (members[0][0], members[-1][1], members[0][2], members[-1][3]))
    if whole[4] >= MIN_SIMILARITY:
        return [whole] if whole[1] - whole[0] >= LEAST_CHAIN else []
    todo, out = [equal_blocks(mine, theirs, members)], set()
    while todo:
        blocks = todo.pop()
        if not blocks:
            continue
        part = align(mine, theirs, (blocks[0][0], blocks[-1][1], blocks[0][2], blocks[-1][3]))
        if part[1] - part[0] < LEAST_CHAIN:
            continue
        if part[4] >= MIN_SIMILARITY:
            out.add(part)
        elif len(blocks) > 1:
            cut = max(range(1, len(blocks)), key=lambda i: blocks[i][0] - blocks[i - 1][1] + blocks[i][2] - blocks[i - 1][3])
            todo += [blocks[:cut], blocks[cut:]]
    return sorted(out)


WINDOWS = "doc_id bigint, low int, high int, mine boolean, theirs boolean, words binary"


def _with_words(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words of each wanted (doc_id, low, high), once for each, with the side or sides of a pair that want them. A text goes to its task once for all windows of a region of it."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, limit=STEP_BYTES):
                for doc_id, text, windows in zip(part.column("doc_id").to_pylist(), utf8(part.column("text")), part.column("windows"), strict=True):
                    words = words_of(text)
                    rows: list[tuple[int, int, int, bool, bool, bytes]] = []
                    size = 0
                    for a, b, mine, theirs in zip(*(windows.values.field(i).to_pylist() for i in range(4)), strict=True):
                        rows.append((doc_id, a, b, mine, theirs, b" ".join(words[max(0, a) : b])))
                        size += len(rows[-1][5])
                        if size > STEP_BYTES:
                            yield _record_batch(rows, WINDOWS)
                            rows, size = [], 0
                    if rows:
                        yield _record_batch(rows, WINDOWS)

    region = F.floor(F.col("low") / REGION).alias("region")
    windows = wanted.groupBy("doc_id", region).agg(F.collect_list(F.struct("low", "high", "mine", "theirs")).alias("windows"))
    return docs.join(windows, "doc_id").select("doc_id", "text", "windows").mapInArrow(task, WINDOWS)


ALIGNED = "doc_id bigint, other_id bigint, start_word int, end_word int, other_start int, other_end int, similarity double"


def _release(spark: SparkSession) -> None:
    """After a table was written: a collection on the driver lets Spark's cleaner remove the shuffle files that only it needed."""
    spark._jvm.System.gc()


def aligned(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Chains, or the parts that those under MIN_SIMILARITY are cut into, with their aligned bounds; those under LEAST_CHAIN are left out."""
    mine = found.select(F.col("doc").alias("doc_id"), (F.col("s") - REACH).alias("low"), (F.col("e") + REACH).alias("high"), F.lit(True).alias("mine"), F.lit(False).alias("theirs"))
    theirs = found.select(F.col("other").alias("doc_id"), (F.col("os") - REACH).alias("low"), (F.col("oe") + REACH).alias("high"), F.lit(False).alias("mine"), F.lit(True).alias("theirs"))
    wanted = mine.unionByName(theirs).groupBy("doc_id", "low", "high").agg(F.max("mine").alias("mine"), F.max("theirs").alias("theirs"))
    path = new_path(docs.sparkSession, "passages")
    _with_words(docs, wanted).write.option("compression", "zstd").parquet(path)
    _release(docs.sparkSession)
    words = docs.sparkSession.read.schema(WINDOWS).parquet(path).withColumns({"low": F.col("low") + REACH, "high": F.col("high") - REACH})
    my_words = words.where("mine").select(F.col("doc_id").alias("doc"), F.col("low").alias("s"), F.col("high").alias("e"), "words")
    other_words = words.where("theirs").select(F.col("doc_id").alias("other"), F.col("low").alias("os"), F.col("high").alias("oe"), F.col("words").alias("their_words"))
    both = found.join(my_words, ["doc", "s", "e"]).drop("e").join(other_words, ["other", "os", "oe"]).drop("oe")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in steps(whole, "words", STEP_BYTES)):
            out = []
            columns = (batch.column(c).to_pylist() for c in ("doc", "other", "s", "os", "runs", "words", "their_words"))
            for doc, other, s, os, members, mine_text, their_text in zip(*columns, strict=True):
                low, other_low = max(0, s - REACH), max(0, os - REACH)
                inside = [(a - low, b - low, c - other_low, d - other_low) for a, b, c, d in zip(*[iter(members)] * 4, strict=True)]
                for a, b, c, d, similarity in aligned_parts(mine_text.split(), their_text.split(), inside):
                    out.append((doc, other, a + low, b + low, c + other_low, d + other_low, similarity))
            if out:
                kinds = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.float64()]
                names = [c.split()[0] for c in ALIGNED.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return both.select("doc", "other", "s", "os", "runs", "words", "their_words").mapInArrow(task, ALIGNED)


def spans(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Add the span of touching chains that each chain lies in; spans under `min_words` go. A document's chains are bounded by its length."""
    order = Window.partitionBy("doc_id").orderBy("start_word", "end_word", "other_id", "other_start")
    reach = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = rows.withColumn("begins", F.coalesce((F.col("start_word") > reach + 1).cast("int"), F.lit(1)))
    grouped = starts.withColumn("span", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    whole = Window.partitionBy("doc_id", "span")
    bounded = grouped.withColumns({"span_start": F.min("start_word").over(whole), "span_end": F.max("end_word").over(whole)})
    return bounded.where(F.col("span_end") - F.col("span_start") >= min_words).drop("begins", "span")


def one_text_per_id(docs: DataFrame) -> DataFrame:
    """(doc_id, text) without null ids or texts; of several texts of one id the one with the smallest hash."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    twice = rows.groupBy("doc_id").count().where("count > 1")
    if twice.isEmpty():
        return rows
    return rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """One row per chain of a repeated passage.

    doc_id, other_id, start_word, end_word, other_start, other_end (word positions, ends excluded), similarity, span_start, span_end.
    """
    rows = one_text_per_id(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MAX_BUCKETS, max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // (BYTES_A_WORD * BUCKET_SEEDS))))
    doc_buckets = max(1, buckets // 2)
    matches = stage(seed_matches(seed_places(rows, buckets), buckets, doc_buckets), "seed_matches")
    _release(docs.sparkSession)
    longer = stage(seed_matches(longer_seeds(matches, buckets, doc_buckets, False), buckets, doc_buckets), "longer_matches")
    longest = seed_matches(longer_seeds(longer, buckets, doc_buckets, True), buckets, doc_buckets)
    all_matches = matches.unionByName(longer).unionByName(longest)
    found = stage(candidate_chains(all_matches, doc_buckets), "chains")
    del all_matches, longest
    _release(docs.sparkSession)
    return spans(aligned(rows, found))
