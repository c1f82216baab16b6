"""Ids of a byte-level BPE file for whole Arrow columns: every distinct chunk of text is encoded once."""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from rankloom.llm.textbatch import span_hashes, text_buffers

#: Chunks a worker remembers; beyond that it forgets all and starts again.
CACHE_CHUNKS = 1_500_000
#: First bytes of the characters beyond ASCII that may be white space: no cut is made beside them.
_DOUBTFUL_2, _DOUBTFUL_3 = 0xC2, (0xE1, 0xE2, 0xE3)
#: First byte of U+00C0 to U+00FF: letters, but for the signs that end in 0x97 and 0xB7.
_LATIN = 0xC3
_BYTES = np.arange(256)
_ASCII_LETTER = ((_BYTES | 32) >= 97) & ((_BYTES | 32) <= 122) & (_BYTES < 128)
_ASCII_SIGN = (_BYTES > 32) & (_BYTES < 127) & ~_ASCII_LETTER & ~((_BYTES >= 48) & (_BYTES <= 57))


def chunk_starts(data: np.ndarray, bounds: np.ndarray, whole: tuple[bytes, ...] = ()) -> np.ndarray:
    """Places where the byte-level pre-tokenizer always begins a token, whatever stands around.

    That is before a space or line feed after a character that is surely not white space, after a
    single line feed between two such characters, and between a letter and an ASCII sign, but never
    inside one of the strings ``whole``, which a tokenizer takes out of the text first.
    """
    doubtful = (data == _DOUBTFUL_2) | np.isin(data, _DOUBTFUL_3)
    solid = data > 32
    ends2 = np.flatnonzero(data == _DOUBTFUL_2) + 1
    ends3 = np.flatnonzero(np.isin(data, _DOUBTFUL_3)) + 2
    solid[ends2[ends2 < len(data)]] = False
    solid[ends3[ends3 < len(data)]] = False
    cut = np.zeros(len(data) + 1, bool)
    after_solid = np.zeros(len(data), bool)
    after_solid[1:] = solid[:-1]
    feed = (data == 10) & after_solid
    cut[:-1] = ((data == 32) & after_solid) | feed
    plain = (data > 32) & ~doubtful
    cut[1:-1] |= feed[:-1] & plain[1:]
    letter = _ASCII_LETTER[data]
    letter[1:] |= (data[:-1] == _LATIN) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    cut[1:-1] |= letter[:-1] & _ASCII_SIGN[data[1:]]
    if whole:
        page = data.tobytes()
        for added in whole:
            at = page.find(added)
            while at >= 0:
                cut[at + 1 : at + len(added)] = False
                at = page.find(added, at + 1)
    cut[bounds] = True
    cut[-1] = False
    return np.flatnonzero(cut)


class Encoder:
    """Worker-side cache over a tokenizer; ids fit 16 bits."""

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        if any(token.lstrip or token.rstrip or token.single_word or token.normalized for token in added):
            raise ValueError("added tokens that read their surroundings cannot be encoded chunk by chunk")
        self.whole = tuple(token.content.encode() for token in added)
        self._clear()

    def _clear(self) -> None:
        self.keys, self.at = np.empty(0, np.uint64), np.zeros(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.ids: np.ndarray = np.empty(0, np.uint16)

    def _learn(self, keys: np.ndarray, chunks: list[str]) -> None:
        if len(self.keys) + len(keys) > CACHE_CHUNKS:
            self._clear()
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]
        size = np.fromiter(map(len, encoded), np.int64, len(encoded))
        at = np.cumsum(size) - size + len(self.ids)
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(encoded), np.uint16, int(size.sum()))))
        place = np.searchsorted(self.keys, keys)  # ``keys`` are sorted
        self.keys, self.at, self.size = (np.insert(old, place, new) for old, new in ((self.keys, keys), (self.at, at), (self.size, size)))

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows in one array, and the n + 1 bounds of the rows."""
        data, bounds = text_buffers(column)
        if not len(data):
            return np.empty(0, np.uint16), np.zeros(len(bounds), np.int64)
        starts = chunk_starts(data, bounds[:-1][np.diff(bounds) > 0], self.whole)
        ends = np.append(starts[1:], len(data))
        keys, example, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(~self._known(keys))
        if len(new):
            if len(self.keys) + len(new) > CACHE_CHUNKS:  # then all of this pass must be learned anew
                self._clear()
                new = np.arange(len(keys))
            whole = data.tobytes()
            self._learn(keys[new], [whole[starts[i] : ends[i]].decode() for i in example[new]])
        place = np.searchsorted(self.keys, keys)[inverse]
        size, at = self.size[place], self.at[place]
        total = np.cumsum(size)
        ids = self.ids[np.repeat(at - (total - size), size) + np.arange(total[-1])]
        return ids, np.concatenate(([0], total))[np.searchsorted(starts, bounds)]


_encoders: dict[int, Encoder] = {}


def encoder(spec: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = hash(spec)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(spec)
    return _encoders[key]
