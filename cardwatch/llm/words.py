"""Words of whole batches of texts as numpy arrays, read off the Arrow buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
LOWER = bytes(range(256)).lower()
IS_WORD = bytes(0 if i in (9, 10, 11, 12, 13, 32) else 1 for i in range(256))
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, eight bytes a round; a round takes the words that have some left."""
    padded = np.zeros(len(low) + 8, np.uint8)
    padded[:len(low)] = low
    eight = np.ndarray((len(low) + 1,), "<u8", padded, 0, (1,))
    left = end - start
    h = mix(left.astype(np.uint64) + _U(_BASE))
    at, todo = start, None  # None: all words
    while True:
        some = np.minimum(left if todo is None else left[todo], 8)
        v = eight[at] & (_U(0xFFFFFFFFFFFFFFFF) >> ((8 - some) * 8).astype(np.uint64))
        if todo is None:
            h = mix(h ^ v)
            todo = np.flatnonzero(left > 8)
        else:
            h[todo] = mix(h[todo] * _U(3) ^ v)
            todo = todo[left[todo] > 8]
        if not len(todo):
            return h
        left[todo] -= 8
        at = start[todo] + (end[todo] - start[todo] - left[todo])


class Texts:
    """The bytes of a batch of texts, ``offsets`` of the texts, and ``start`` and ``end`` of all words (runs of
    the bytes that ``is_word`` marks, by default all but ASCII white space; split at the ends of texts)."""

    def __init__(self, texts: pa.Array, is_word: bytes = IS_WORD):
        texts = pc.fill_null(texts.cast(pa.string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        self.text = data[offsets[0]:offsets[-1]].to_pybytes() if data is not None else b""
        self.raw, self.offsets = np.frombuffer(self.text, np.uint8), offsets - offsets[0]
        self.full = np.flatnonzero(np.diff(self.offsets))
        word = np.frombuffer(self.text.translate(is_word), bool)
        # a word begins or ends where white space and other bytes meet
        edge = np.zeros(len(word) + 1, bool)
        if len(word):
            np.not_equal(word[1:], word[:-1], out=edge[1:-1])
            edge[0], edge[-1] = word[0], word[-1]
        edges = np.flatnonzero(edge)
        start, end = edges[::2], edges[1::2]
        joint = self.offsets[self.full[1:]]
        joint = joint[word[joint] & word[joint - 1]] if len(joint) else joint
        if len(joint):  # texts that touch each other
            start, end = (np.insert(x, np.searchsorted(x, joint), joint) for x in (start, end))
        self.start, self.end = start, end

    def lines(self) -> np.ndarray:
        """Word numbers at which a line with words begins; sets ``row`` (of the batch) and ``number`` (in its
        text, from 0) of these lines, and ``line`` (running number) of each word."""
        start, ends = self.start, np.flatnonzero(self.raw == 10)
        at = np.unique(np.searchsorted(start, np.r_[self.offsets[self.full], ends]))
        at = at[at < len(start)]
        first = start[at]
        at_full = np.searchsorted(self.offsets[self.full], first, "right") - 1
        self.row = self.full[at_full] if len(first) else first
        self.number = np.searchsorted(ends, first) - np.searchsorted(ends, self.offsets[self.row])
        new = np.zeros(len(start), np.int64)
        new[at] = 1
        self.line = np.cumsum(new) - 1
        return at
