"""Whole texts to token ids with a public byte-level BPE, each distinct cut encoded once.

A byte-level tokenizer cuts a text by a pattern and encodes the cuts one by one. So the ids of a text are those of its cuts, and each
distinct cut goes through the library's model once per task. The pattern itself is only run on distinct chunks: a text is first
split before every space, which is a cut of the pattern unless the space lies inside a longer run of white space (those texts are cut whole).
What a task remembers is bounded by bytes (KNOWN_BYTES of cuts with their ids) and dropped with the task.
Other tokenizers encode whole texts. So do texts that contain the string of an added token (such as <|endoftext|>), which
the library cuts out before its pattern.
"""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

# fixed value: the pattern of the byte-level pre-tokenizer
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_INSIDE_RUN = r"[\s\p{Z}\x0b\x1c-\x1f\x85] [\s\p{Z}\x0b\x1c-\x1f\x85]"
KNOWN_BYTES = 64_000_000
_SIGNS = frozenset(".,;:!?)")


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return dict(zip(seen, map(chr, seen), strict=True)) | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(seen))}


_BYTE_CHARS = _byte_chars()
_WRITTEN = np.array([ord(_BYTE_CHARS[b]) for b in range(256)], dtype="<u2")
_NO_BYTE = 0xFF  # in no UTF-8 text
_ID = attrgetter("id")


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, models

        self.tokenizer = Tokenizer.from_file(path)
        kind, model = str(self.tokenizer.pre_tokenizer).replace(" ", ""), self.tokenizer.model
        self.by_cuts = kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and "use_regex=True" in kind and self.tokenizer.normalizer is None
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        # every byte has a token, so the tokens of a cut are its bytes, no more and no fewer
        self.by_cuts = self.by_cuts and isinstance(model, models.BPE) and not (model.dropout or model.continuing_subword_prefix or model.end_of_word_suffix) and vocab.keys() >= set(_BYTE_CHARS.values())
        self.token_bytes = np.zeros(max(vocab.values(), default=0) + 1, dtype=np.int64)
        self.token_bytes[list(vocab.values())] = list(map(len, vocab))
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.by_cuts = self.by_cuts and not any("\n" in t for t in added)
        self.added = "|".join("".join(f"\\x{{{ord(c):x}}}" for c in t) for t in added)
        self.forget()

    def forget(self) -> None:
        self.known, self.known_ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_cuts(self, cuts: pa.Array) -> pa.Array:
        """The ids of each cut: what the model makes of its bytes, each byte as the character that stands for it."""
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(cuts)], pa.int32()), cuts.cast(pa.binary())), bytes((_NO_BYTE,)))[0].as_py()
        written = _WRITTEN[np.frombuffer(joined, np.uint8)].tobytes().decode("utf-16-le").split(_BYTE_CHARS[_NO_BYTE])
        ids = np.fromiter(map(_ID, chain.from_iterable(map(self.tokenizer.model.tokenize, written))), dtype="<u4")
        # a cut ends where as many bytes have been written as it and those before it have
        ends = np.cumsum(np.append(0, pc.binary_length(cuts).to_numpy(zero_copy_only=False)))
        at = np.cumsum(np.append(0, self.token_bytes[ids]))
        bounds = np.searchsorted(at, ends)
        if at[-1] != ends[-1] or not np.array_equal(at[bounds], ends):
            raise ValueError("tokens do not end with their cuts")
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(4 * bounds), pa.py_buffer(ids)])

    def _cut_ids(self, cuts: list[str], sizes: list[int]) -> pa.Array:
        """The ids of chunks or texts that are given as their cuts, `sizes` of them each."""
        coded = pa.array(cuts, pa.string()).dictionary_encode()
        distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        place = pc.index_in(distinct, value_set=self.known)
        new = distinct.filter(pc.is_null(place))
        place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = len(self.known) + np.arange(len(new))
        ids = pa.concat_arrays([self.known_ids, self._encode_cuts(new)])
        if self.known.nbytes + new.nbytes + ids.nbytes > KNOWN_BYTES:
            self.known, self.known_ids = distinct, ids.take(pa.array(place))
        else:
            self.known, self.known_ids = pa.concat_arrays([self.known, new]), ids
        found = ids.take(pa.array(place[codes]))
        _, offsets, data = found.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(found) + 1)[np.cumsum([0, *sizes])]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), data])

    def _cuts(self, chunks: list[str], heads: list[str]) -> tuple[list[str], list[int]]:
        """The cuts of chunks after a space and of texts' heads, and how many each has. A chunk of letters is one cut with its space, a sign after
        letters is another."""
        cuts, sizes = [], []
        for chunk in chunks:
            if chunk.isalpha():
                cuts.append(" " + chunk)
                sizes.append(1)
            elif chunk[-1:] in _SIGNS and chunk[:-1].isalpha():
                cuts += (" " + chunk[:-1], chunk[-1])
                sizes.append(2)
            else:
                own = _CUT.findall(" " + chunk)
                cuts += own
                sizes.append(len(own))
        for head in heads:
            own = _CUT.findall(head)
            cuts += own
            sizes.append(len(own))
        return cuts, sizes

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The token ids of all texts, one after another, and how many each has. Null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_cuts:
            raw = self._encode(texts.to_pylist())
            return np.frombuffer(b"".join(raw), "<u4"), np.array([len(r) // 4 for r in raw], dtype=np.int64)
        if self.added:
            whole = pc.match_substring_regex(texts, self.added)
            if pc.any(whole).as_py():
                return self._some_whole(texts, whole)
        return self._by_cuts(texts)

    def _some_whole(self, texts: pa.Array, whole: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids() of texts of which those marked go through the library whole."""
        marked = whole.to_numpy(zero_copy_only=False)
        ids, counts = self._by_cuts(pc.filter(texts, pc.invert(whole)))
        parts = np.empty(len(marked), dtype=object)
        parts[~marked] = np.array([*np.split(ids, np.cumsum(counts)[:-1]), None], dtype=object)[:-1] if len(counts) else []
        parts[marked] = np.array([*(np.frombuffer(r, "<u4") for r in self._encode(pc.filter(texts, whole).to_pylist())), None], dtype=object)[:-1]
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)

    def _by_cuts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, dtype="<u4"), np.zeros(0, dtype=np.int64)
        odd = pc.match_substring_regex(texts, _INSIDE_RUN)
        # texts to cut whole keep one part
        parts = pc.split_pattern(pc.if_else(odd, "", texts), pattern=" ")
        sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        coded = pc.list_flatten(parts).dictionary_encode()
        chunks, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        heads = pc.if_else(odd, texts, chunks.take(pa.array(codes[firsts])))
        # a chunk that only begins texts is learned, too: few are
        ids = self._cut_ids(*self._cuts(_strings(chunks), _strings(heads)))
        # every place takes the ids of its chunk, or of its text's head
        which = codes.astype(np.int64)
        which[firsts] = len(chunks) + np.arange(len(heads))
        found = ids.take(pa.array(which))
        _, offsets, data = found.buffers()
        bounds = np.frombuffer(offsets, np.int64, len(found) + 1, 8 * found.offset) // 4
        all_ids = np.frombuffer(data, "<u4", bounds[-1])[bounds[0] :] if bounds[-1] else np.zeros(0, dtype="<u4")
        return all_ids, np.diff(np.append(bounds[firsts], bounds[-1]))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker. A task that is done with it calls forget()."""
    return Encoder(path)
