"""Static range asymmetric numeral system over token ids, with numpy.

A segment holds the ids of some documents. One frequency table, made from all ids of the segment, is shared by its blocks. A block
has up to BLOCK_TOKENS ids dealt to LANES interleaved coders with one common stream of 32-bit words; blocks are independent, so each is a
checkpoint: the directory has its first word, its lanes' start states, a checksum of its words and one of its ids. All blocks of a
segment have one length and are coded side by side as one numpy vector.

Layout, little-endian: magic, header, CRC-32 of what follows up to the words, zlib(doc ids), zlib(null marks), zlib(ids per document), zlib(symbols),
zlib(frequencies), directory (four u32 per block), states (u64 per block and lane), words (u32).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"SRA1"
LANES = 64
STEPS = 1024
BLOCK_TOKENS = LANES * STEPS
SCALE = 20
_LOW = np.uint64(1 << 32)
_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE)
_MASK = np.uint64((1 << SCALE) - 1)
_TOP = np.uint64(64 - SCALE)
_HEADER = struct.Struct("<QIIII5II")


class Corrupt(ValueError):
    """A checksum does not fit."""


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, frequencies): every id that occurs gets at least 1 of 2**SCALE."""
    counts = np.bincount(ids) if len(ids) else np.zeros(0, dtype=np.int64)
    symbols = np.flatnonzero(counts)
    room = 1 << SCALE
    if len(symbols) > room:
        raise ValueError("more distinct ids than the table has places")
    if not len(symbols):
        return symbols.astype(np.uint32), symbols.astype(np.uint32)
    freqs = 1 + (counts[symbols] * (room - len(symbols))) // counts.sum()
    freqs[freqs.argmax()] += room - freqs.sum()
    return symbols.astype(np.uint32), freqs.astype(np.uint32)


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """`counts` places from each start on."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def encode(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment. `ids` are those of all documents, one after another."""
    symbols, freqs = frequency_table(ids)
    n_blocks = -(-len(ids) // BLOCK_TOKENS)
    steps = -(-len(ids) // (n_blocks * LANES)) if n_blocks else 0
    block = steps * LANES
    rank = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, dtype=np.int32)
    rank[symbols] = np.arange(len(symbols), dtype=np.int32)
    padded = np.full(n_blocks * block, freqs.argmax() if len(freqs) else 0, dtype=np.int32)
    padded[: len(ids)] = rank[ids]
    ranks = padded.reshape(n_blocks, steps, LANES)
    freq = freqs.astype(np.uint64)
    base = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else freq
    rows = np.arange(n_blocks) * block
    state = np.full((n_blocks, LANES), _LOW, dtype=np.uint64)
    words = np.zeros((n_blocks, block), dtype=np.uint32)
    at = np.full(n_blocks, block, dtype=np.int64)
    if len(freq) != 1:  # a single symbol fills the table: nothing to write
        lane, flat = state.reshape(-1), words.reshape(-1)
        for step in range(steps - 1, -1, -1):
            r = ranks[:, step, :].astype(np.intp)
            f = freq.take(r)
            full = (state >> _TOP) >= f
            run = np.count_nonzero(full, axis=1)
            at -= run
            which = np.flatnonzero(full)
            long = lane.take(which)
            flat[_places(at + rows, run)] = long
            lane[which] = long >> _WORD
            q = state // f
            f *= q
            np.subtract(state, f, out=f)
            f += base.take(r)
            np.left_shift(q, _SCALE, out=state)
            state += f
    streams = [words[b, at[b] :] for b in range(n_blocks)]
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], dtype="<i8")
    parts = [zlib.compress(np.ascontiguousarray(a).tobytes(), 6) for a in (np.diff(numbers, prepend=0), known, lengths.astype("<u4"), symbols.astype("<u4"), freqs.astype("<u4"))]
    directory = np.zeros((n_blocks, 4), dtype="<u4")
    first = 0
    for b, stream in enumerate(streams):
        own = ids[b * block : (b + 1) * block].astype("<u4").tobytes()
        directory[b] = first, len(stream), zlib.crc32(stream.tobytes(), zlib.crc32(state[b].tobytes())), zlib.crc32(own)
        first += len(stream)
    body = b"".join([*parts, directory.tobytes(), state.astype("<u8").tobytes()])
    header = _HEADER.pack(len(ids), len(doc_ids), n_blocks, LANES, steps, *map(len, parts), zlib.crc32(body))
    return b"".join([MAGIC, header, body, *(s.astype("<u4").tobytes() for s in streams)])


class Segment:
    """A parsed segment; blocks are decoded on demand."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise Corrupt("not a segment")
        head = _HEADER.unpack_from(blob, 4)
        self.n_tokens, n_docs, self.n_blocks, lanes, self.steps = head[:5]
        at = 4 + _HEADER.size
        end = at + sum(head[5:10]) + self.n_blocks * (16 + 8 * lanes)
        if zlib.crc32(blob[at:end]) != head[10] or lanes != LANES:
            raise Corrupt("header")
        raw = []
        for size in head[5:10]:
            raw.append(zlib.decompress(blob[at : at + size]))
            at += size
        numbers, known = np.cumsum(np.frombuffer(raw[0], "<i8")), np.frombuffer(raw[1], np.uint8)
        self.doc_ids = [int(n) if k else None for n, k in zip(numbers, known, strict=True)]
        assert len(self.doc_ids) == n_docs
        self.lengths = np.frombuffer(raw[2], "<u4").astype(np.int64)
        self.symbols, freqs = np.frombuffer(raw[3], "<u4"), np.frombuffer(raw[4], "<u4")
        self.directory = np.frombuffer(blob, "<u4", self.n_blocks * 4, at).reshape(-1, 4)
        at += self.n_blocks * 16
        self.states = np.frombuffer(blob, "<u8", self.n_blocks * lanes, at).reshape(-1, lanes)
        self.words = np.frombuffer(blob, "<u4", offset=end)
        self.freq = freqs.astype(np.uint64)
        self.base = (np.cumsum(self.freq) - self.freq).astype(np.uint64)
        self.rank = np.repeat(np.arange(len(freqs), dtype=np.int32), freqs)

    def blocks(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of some blocks, without touching others."""
        last = self.n_blocks if last is None else last
        n, block = last - first, self.steps * LANES
        size = min(self.n_tokens, last * block) - first * block
        if n <= 0:
            return np.zeros(0, dtype=np.uint32)
        if len(self.symbols) == 1:
            return np.full(size, self.symbols[0], dtype=np.uint32)
        own = self.directory[first:last].astype(np.int64)
        state = self.states[first:last].astype(np.uint64)
        words = np.zeros((n, own[:, 1].max() + 1), dtype=np.uint64)
        for b, (start, length, check, _) in enumerate(own):
            stream = self.words[start : start + length]
            if zlib.crc32(stream.tobytes(), zlib.crc32(self.states[first + b].tobytes())) != check:
                raise Corrupt(f"words of block {first + b}")
            words[b, :length] = stream
        out = np.zeros((n, self.steps, LANES), dtype=np.int32)
        at = np.arange(n) * words.shape[1]
        lane, flat = state.reshape(-1), words.reshape(-1)
        for step in range(self.steps):
            slot = state & _MASK
            r = self.rank.take(slot.view(np.int64))
            out[:, step, :] = r
            r = r.astype(np.intp)
            slot -= self.base.take(r)
            state >>= _SCALE
            state *= self.freq.take(r)
            state += slot
            short = state < _LOW
            run = np.count_nonzero(short, axis=1)
            which = np.flatnonzero(short)
            lane[which] = (lane.take(which) << _WORD) | flat.take(_places(at, run))
            at += run
        ids = self.symbols[out.reshape(-1)[:size]].astype(np.uint32)
        for b in range(n):
            part = ids[b * block : (b + 1) * block]
            if zlib.crc32(part.astype("<u4").tobytes()) != own[b, 3]:
                raise Corrupt(f"ids of block {first + b}")
        return ids
