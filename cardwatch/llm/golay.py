"""Keys of 64-bit fingerprints from the perfect binary Golay code.

Every 23-bit word lies within three bits of exactly one of the 4,096 codewords.
A fingerprint is cut into segments of 22, 21 and 21 bits, each read as the low bits
of a 23-bit word; a codeword's index is its 12 data bits.

``home``: the index of the segment's own codeword.  ``nearby``: the indices of all
codewords that the segment, or the segment with any one bit changed, decodes to
(one, or about six if the segment is three bits off its codeword).  If two segments
differ in one bit at most, the home index of one is among the nearby ones of the
other.

Pigeonhole for at most four differing bits in three segments: the two segments with
the fewest errors have (0, 0), (0, 1), (1, 1) or (0, 2) of them.  The first three
cases are met by a pair of segments whose indices agree (``home`` of one side,
``nearby`` of the other); the last leaves one segment unchanged, whose bits
themselves are a key.
"""

from __future__ import annotations

import numpy as np

WIDTHS = (22, 21, 21)
SHIFTS = (42, 21, 0)
MAX_ERRORS = 4
PAIRS = ((0, 1), (0, 2), (1, 2))
_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainders() -> np.ndarray:
    """Remainder of x^i by the generator, for each of the 23 bits."""
    out, r = [], 1
    for _ in range(23):
        out.append(r)
        r <<= 1
        if r >> 11:
            r ^= _GENERATOR
    return np.array(out, np.int64)


def syndrome(words: np.ndarray) -> np.ndarray:
    s = np.zeros(words.shape, np.int64)
    for i, r in enumerate(_remainders()):
        s ^= np.where((words >> i) & 1, r, 0)
    return s


def _error_of_syndrome() -> np.ndarray:
    bit = [1 << i for i in range(23)]
    errors = [0, *bit, *(a | b for i, a in enumerate(bit) for b in bit[:i]),
              *(a | b | c for i, a in enumerate(bit) for j, b in enumerate(bit[:i]) for c in bit[:j])]
    e = np.array(errors, np.int64)
    table = np.zeros(2048, np.int64)
    table[syndrome(e)] = e
    return table


_ERRORS = _error_of_syndrome()


def index_of(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    return (words ^ _ERRORS[syndrome(words)]) >> 11


def segments(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.astype(np.uint64)
    return [((u >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(SHIFTS, WIDTHS)]


def _nearby(segment: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted indices (n, 1 + width) and a mask of the first of equal ones."""
    flips = np.array([0, *(1 << i for i in range(width))], np.int64)
    found = np.sort(index_of(segment[:, None] ^ flips[None, :]), axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, first


def _key(tag: int, value: np.ndarray) -> np.ndarray:
    return (np.int64(tag) << 40) | value


def home_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the six keys of each fingerprint."""
    parts = segments(fp)
    index = [index_of(p) for p in parts]
    rows = np.arange(len(fp))
    keys = [_key(k, index[i] << 12 | index[j]) for k, (i, j) in enumerate(PAIRS)]
    keys += [_key(3 + i, p) for i, p in enumerate(parts)]
    return np.tile(rows, len(keys)), np.concatenate(keys) if keys else rows


def probe_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the keys that meet a home key of every fingerprint within four bits."""
    parts = segments(fp)
    near = [_nearby(p, w) for p, w in zip(parts, WIDTHS)]
    rows, keys = [], []
    for k, (i, j) in enumerate(PAIRS):
        (a, first_a), (b, first_b) = near[i], near[j]
        r, x, y = np.nonzero(first_a[:, :, None] & first_b[:, None, :])
        rows.append(r)
        keys.append(_key(k, a[r, x] << 12 | b[r, y]))
    for i, p in enumerate(parts):
        rows.append(np.arange(len(fp)))
        keys.append(_key(3 + i, p))
    return np.concatenate(rows), np.concatenate(keys)
