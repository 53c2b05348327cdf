"""Words and grams of whole Arrow batches, with numpy: no Python loop over words.

A slice of a batch is the UTF-8 bytes of its texts, one behind the other. Word hashes come
from prefix sums of byte values times powers of an odd number, grams from sums of word hashes
times powers of another one; all arithmetic is modulo 2^64, and results are mixed at the end.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 100_000
U = np.uint64
BASE, UNBASE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
STEP, UNSTEP = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
SPACE_WORD = ~SPACES
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
NAME_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])
CONTINUES = (np.arange(256) & 0xC0) == 0x80



def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n - 1) modulo 2^64, kept for the next call.

    Functions come to a worker anew with each task. What they keep in a module of the
    worker's own is made once, and not once a task.
    """
    kept = vars(sys.modules.setdefault("_chartfold_powers", types.ModuleType("_chartfold_powers")))
    name = f"p{base}"
    if name not in kept or len(kept[name]) < n:
        p = np.full(1 << max(17, int(n).bit_length()), U(base))
        p[0] = 1
        kept[name] = np.multiply.accumulate(p)
    return kept[name][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and n + 1 offsets into them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray,
           size: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts texts into runs of about SLICE_BYTES: (first, last, bytes, offsets). Texts stay whole."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + (size or SLICE_BYTES), "right")) - 1)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def marks(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of `inside`, which never cross a text's end."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    before[cuts] = False
    after[cuts - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span."""
    sums = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * powers(UNBASE, len(data) + 1)[starts]
    return mixed(h + (ends - starts).astype(U) * U(STEP))


class Words:
    """Words of a slice: byte starts and ends, hashes, and `first`, n + 1 places of texts in them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = SPACE_WORD, lower: bool = False):
        self.starts, self.ends = marks(kind[data], offsets)
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = spans_hash(LOWERED[data] if lower else data, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of all k-grams within texts, their texts, and their hashes."""
        return grams(self.hashes, self.first, k)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each item, from the n + 1 places of texts."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def grams(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    of = owners(first)
    places = np.arange(len(hashes))
    fits = places + k <= first[1:][of]
    places = places[fits]
    return places, of[fits], window_hash(hashes, places, places + k)


def window_hash(hashes: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """A hash of the items of each span of items."""
    sums = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * powers(STEP, len(hashes)), out=sums[1:])
    return mixed((sums[highs] - sums[lows]) * powers(UNSTEP, len(hashes) + 1)[lows] + (highs - lows).astype(U))


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values by text."""
    sums = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def covered(n: int, starts: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """Which of n items lie in a span that begins at one of the starts."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys
