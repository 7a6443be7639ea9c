"""Words of whole texts as arrays: places, 64-bit hashes, and hashes of consecutive runs.

A word is a longest run without the six ASCII white-space characters. The work is
done on the UTF-8 bytes of an Arrow string array, without a Python object a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Any odd factor and any seed do; every task has to use the same ones.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_SLICE_BYTES = 1 << 18
_LETTERS = np.random.Generator(np.random.PCG64(20240501)).integers(1, 1 << 63, 256).astype(np.uint64)
_FOLDED = _LETTERS.copy()
_FOLDED[65:91] = _LETTERS[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the factor, and of its inverse."""
    if len(_POWERS[0]) < n:
        for at, base in enumerate((_FACTOR, _INVERSE)):
            line = np.full(n, base, np.uint64)
            line[0] = 1
            _POWERS[at] = np.multiply.accumulate(line)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


@dataclass
class Words:
    """Of some texts in order: ``hashes``, and byte places (``starts``, ``ends``) in ``data``, of all words;
    the words of text i are those from ``offsets[i]`` to ``offsets[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    offsets: np.ndarray

    def runs(self, k: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the k words from each word on, and whether they lie in one text."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(n, np.uint64), np.zeros(n, bool)
        powers, inverse = _powers(n + 1)
        letters = self.hashes if not salt else mix(self.hashes + np.uint64(salt))
        sums = _sums(letters * powers[:n])
        out = np.zeros(n, np.uint64)
        out[: n - k + 1] = mix((sums[k:] - sums[: n - k + 1]) * inverse[: n - k + 1] + np.uint64(k))
        left = np.repeat(self.offsets[1:], np.diff(self.offsets)) - np.arange(n)
        return out, left >= k

    def whole(self) -> np.ndarray:
        """The hash of each text's whole word sequence."""
        n = len(self.hashes)
        powers, inverse = _powers(n + 1)
        sums, at = _sums(self.hashes * powers[:n]), self.offsets
        return mix((sums[at[1:]] - sums[at[:-1]]) * inverse[at[:-1]] + np.diff(at).astype(np.uint64))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array without nulls, and where each text starts."""
    texts = texts.cast(pa.large_string()) if pa.types.is_string(texts.type) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, fold: bool = False) -> Words:
    """The words of a string array without nulls; ``fold`` takes A-Z for a-z."""
    data, offsets = text_bytes(texts)
    n = len(data)
    space = _SPACE[data]
    before = np.ones(n, bool)
    before[1:] = space[:-1]
    firsts = offsets[:-1]
    before[firsts[firsts < n]] = True
    starts = np.flatnonzero(~space & before)
    after = np.ones(n, bool)
    after[:-1] = space[1:]
    lasts = offsets[1:] - 1
    after[lasts[lasts >= 0]] = True
    ends = np.flatnonzero(~space & after) + 1
    powers, inverse = _powers(n + 1)
    sums = _sums((_FOLDED if fold else _LETTERS)[data] * powers[:n])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def slices(texts: pa.Array, limit: int = _SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text, so that the arrays made of them stay small."""
    sizes = np.asarray(pc.binary_length(texts).fill_null(0))
    part = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    bounds = [0, *cuts.tolist(), len(texts)]
    yield from ((a, b) for a, b in zip(bounds, bounds[1:]) if b > a)
