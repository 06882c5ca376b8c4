"""Word and shingle hashes of whole texts, vectorised over Arrow buffers.

Words are runs of bytes other than \\x20 and \\x09-\\x0D, with A-Z lower-cased.
A word's hash takes its length and then its bytes, eight at a time, through a
64-bit finaliser; a word of more than ``_LONG`` bytes is hashed by XXH3. Neither
is linear in the bytes, so there are no strings that collide by their structure.
A shingle's hash combines the hashes of its words.
"""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Words of more bytes are hashed one by one.
_LONG = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_IS_WORD = np.ones(256, bool)
_IS_WORD[list(_SPACES)] = False
#: Instead: runs of ASCII letters and digits and of bytes beyond ASCII.
LETTERS = np.zeros(256, bool)
LETTERS[128:] = LETTERS[0x30:0x3A] = LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B] = True
_ORDER = mix(np.arange(1, 65, dtype=np.uint64) * _U(0xA0761D6478BD642F)) | _U(1)


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; words end where their row ends."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = kind[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = offsets[:-1]
    before[cuts[cuts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    cuts = offsets[1:]
    after[cuts[cuts > 0] - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = _IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words in each row)."""
    starts, ends = word_bounds(data, offsets, kind)
    counts = np.diff(np.searchsorted(starts, offsets, side="left"))
    size = ends - starts
    out = mix(size.astype(np.uint64) * _ORDER[-1])
    if not len(starts):
        return out, counts
    low = np.zeros(len(data) + 8, np.uint8)
    np.take(_LOWER, data, out=low[:-8])
    lanes = np.ndarray((len(data) + 1,), "<u8", low, strides=(1,))  # the eight bytes from each place on
    rows = np.flatnonzero(size <= _LONG)
    for at in range(0, _LONG, 8):
        rows = rows[size[rows] > at] if at else rows
        if not len(rows):
            break
        left = size[rows] - at
        lane = lanes[starts[rows] + at]
        short = left < 8
        lane[short] &= (_U(1) << (left[short].astype(np.uint64) << _U(3))) - _U(1)
        out[rows] = mix(out[rows] ^ lane * _ORDER[-2])
    for i in np.flatnonzero(size > _LONG):
        out[i] = xxhash.xxh3_64_intdigest(low[starts[i]:ends[i]])
    return out, counts


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one row in order; fewer words, but not
    none, are one shingle."""
    n = len(words)
    if not n:
        return words
    width = min(n, k)
    out = np.full(n - width + 1, _ORDER[k + width], np.uint64)
    for i in range(width):
        out += words[i:n - width + 1 + i] * _ORDER[i]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """For each row its sorted distinct shingle hashes."""
    words, counts = word_hashes(data, offsets)
    ends = np.cumsum(counts)
    for i in range(len(counts)):
        own = np.sort(shingles(words[ends[i] - counts[i]:ends[i]], k))
        yield own[np.append(True, own[1:] != own[:-1])] if len(own) else own
