"""Words and word shingles of a batch of texts as numpy arrays of hashes.

The UTF-8 bytes of an Arrow string column are classified byte by byte, so no Python object is made per
word. A word's hash takes in eight bytes at a time; a shingle's hash mixes the hashes of its words. Both
have 64 bits and are the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
# Texts are taken together up to this many bytes, to bound the arrays in memory.
SLICE_BYTES = 500_000


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbers(seed: int, n: int) -> np.ndarray:
    """``n`` fixed random odd numbers of 64 bits."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(steps + mixed(np.array([seed], dtype=np.uint64))) | np.uint64(1)


_SALT = numbers(1, 1)[0]
_HELD = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_PLACE = numbers(3, SHINGLE_WORDS)

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32

_ALL = np.arange(256)
# Letters, digits and everything beyond ASCII.
ALPHANUMERIC = ((_ALL >= 0x30) & (_ALL <= 0x39)) | ((_ALL >= 0x41) & (_ALL <= 0x5A)) | ((_ALL >= 0x61) & (_ALL <= 0x7A)) | (_ALL >= 0x80)
# Everything but a space and the control characters from tab to carriage return.
NOT_SPACE = ~((_ALL == 0x20) | ((_ALL >= 0x09) & (_ALL <= 0x0D)))


@dataclass
class Words:
    """Words of consecutive texts: ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray  # the folded bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """Eight bytes of all words are mixed in at a time, then the next eight of those that go on."""
        n = len(self.data)
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eights = np.ndarray((n + 1,), np.uint64, padded, strides=(1,)).copy()  # at every byte
        length = self.end - self.start
        out = length.astype(np.uint64) * _SALT
        which, at, left = np.arange(len(length)), self.start, length
        while len(which):
            piece = eights[at] & _HELD[np.minimum(left, 8)]
            out[which] = mixed((out[which] ^ piece) * _SALT)
            on = np.flatnonzero(left > 8)
            which, at, left = which[on], at[on] + 8, left[on] - 8
        return out

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray) -> Words:
    """The words, in lower case for A-Z, of the texts ``data[bounds[d]:bounds[d + 1]]``."""
    inside = kind[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]  # a text's end also ends its last word
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    return Words(_FOLD[data], start, np.flatnonzero(ends) + 1, np.searchsorted(start, bounds))


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of bounded size as (index of the first, bytes, bounds); null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, "right")) - 1)
        yield at, data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = SHINGLE_WORDS, whole: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of consecutive texts and the bounds of each text's share.

    A text of fewer words than ``width``, but not none, has its whole sequence as its only shingle, or no
    shingle if ``whole`` is false.
    """
    count = np.diff(first)
    share = np.where(count >= width, count - width + 1, np.minimum(count, 1) * whole)
    bounds = np.concatenate(([0], np.cumsum(share)))
    total = int(bounds[-1])
    at = np.repeat(first[:-1] - bounds[:-1], share) + np.arange(total)
    held = np.repeat(np.minimum(count, width), share)
    padded = np.concatenate((hashes, np.zeros(width, np.uint64)))
    out = held.astype(np.uint64)
    for k in range(width):
        out = out + np.where(k < held, padded[at + k], np.uint64(0)) * _PLACE[k]
    return mixed(out), bounds
