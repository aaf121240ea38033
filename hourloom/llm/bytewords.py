"""Words of many texts at once: byte offsets and 64-bit hashes by numpy, for use inside tasks.

Words are maximal runs of bytes other than ASCII white space (0x20, 0x09-0x0D); A-Z counts as a-z. No byte of a
multi-byte UTF-8 character is below 0x80, so working on bytes gives the same words as working on characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256).astype(np.uint64)
_VALUES[65:91] = _VALUES[97:123]
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        both = []
        for base in (_MULTIPLIER, _INVERSE):
            steps = np.full(size, base)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers = (both[0], both[1])
    return _powers[0][:n], _powers[1][:n]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array back to back and the n + 1 offsets of its texts; null has no bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """P with P[0] = 0; (P[j] - P[i]) * inverse**i identifies the bytes i..j, letter case of A-Z aside."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers(len(raw) + 1)[0][:-1], out=sums[1:])
    return sums


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, hash) of every word, in order; words end where their text ends. Texts are given by their offsets."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    inside = ~_SPACE[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = prefix_sums(raw)
    length = (end - start).astype(np.uint64)
    hashed = mix((sums[end] - sums[start]) * powers(len(raw) + 1)[1][start] + length * np.uint64(0x2545F4914F6CDD1D))
    return start, end, hashed


def word_bounds(start: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """n + 1 positions in the word list at which the texts begin."""
    return np.searchsorted(start, offsets).astype(np.int64)


def chain(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive words, by its first word; the last n - 1 positions are left out."""
    out = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[i : len(hashes) - n + 1 + i])
    return out
