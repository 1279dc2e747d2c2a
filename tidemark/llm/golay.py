"""Binary Golay code (23,12): every 23-bit word is within distance 3 of exactly one codeword."""

from functools import cache
from itertools import combinations

import numpy as np

BITS = 23
_GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _syndrome(words: np.ndarray) -> np.ndarray:
    rest = words.astype(np.int64)
    for bit in range(BITS - 1, 10, -1):
        rest ^= ((rest >> bit) & 1) * (_GENERATOR << (bit - 11))
    return rest


@cache
def _errors() -> np.ndarray:
    """Error pattern of weight 3 or less by syndrome."""
    patterns = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(BITS), n)])
    table = np.full(1 << 11, -1, np.int64)
    table[_syndrome(patterns)] = patterns
    return table


def index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword each 23-bit word decodes to."""
    return (words ^ _errors()[_syndrome(words)]) >> 11


def near_indices(words: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices of each word and of all words one of its low ``bits`` away, without repeats.

    Returns the row number and the index. Words one bit apart always share an index: each is among
    the other's neighbours. Most words have 6 indices, the others 1.
    """
    flips = np.concatenate([[0], 1 << np.arange(bits)])
    found = np.sort(index(words[:, None] ^ flips[None, :]), axis=1)
    fresh = np.ones(found.shape, bool)
    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, cols = np.nonzero(fresh)
    return rows, found[rows, cols]


@cache
def _half() -> np.ndarray:
    """The codewords of index below 2048 as columns of +1 and -1; the others are their complements."""
    words = np.arange(1 << 11) << 11
    words ^= _syndrome(words)
    return np.ascontiguousarray(((words[None, :] >> np.arange(BITS)[:, None]) & 1) * 2 - 1).astype(np.float32)


def nearest(values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and correlations of the ``count`` codewords nearest to rows of 23 real values, the nearest first.

    This is soft decoding: a value near zero, whose sign a small change turns, weighs little.
    """
    found = values.astype(np.float32) @ _half()
    strong = np.abs(found).reshape(len(values), 16, 128)
    # the largest lie in the columns of the largest maxima
    cols = np.argpartition(strong.max(axis=1), -count, axis=1)[:, -count:]
    at = (np.arange(16)[None, :, None] * 128 + cols[:, None, :]).reshape(len(values), -1)
    among = np.take_along_axis(found, at, 1)
    order = np.argsort(-np.abs(among), axis=1)[:, :count]
    at, score = np.take_along_axis(at, order, 1), np.take_along_axis(among, order, 1)
    return np.where(score > 0, at, at ^ 4095), np.abs(score)
