"""Words, word hashes and shingles of an Arrow batch of texts, as numpy arrays.

A word is a run of bytes other than space and the controls 9 to 13, so texts
are cut the same way in SQL by ``[^\\x20\\x09-\\x0D]+``. All hashes are sums of
random values times powers of an odd number, modulo 2^64: prefix sums give the
hash of any run in constant time. A final mix spreads them over 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes of text that are worked on at once; a longer text is taken alone.
PIECE_BYTES = 1 << 18

_BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xD1342543DE82EF95)
SECOND_BASE = np.uint64(0xAF251AF3B0F025B5)
_RANDOM = np.random.default_rng(20240607)
_BYTE_VALUES = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_FOLDED_VALUES = _BYTE_VALUES.copy()
_FOLDED_VALUES[65:91] = _BYTE_VALUES[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True


class Words(NamedTuple):
    """Words of a batch: word ``i`` is ``data[start[i]:end[i]]``; text ``d`` holds words ``first[d]`` to
    ``first[d + 1]``, none if it is null."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: a one-to-one map whose bits all depend on all bits."""
    x = np.array(values, np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, count: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``count`` powers of ``base``, and of its inverse modulo 2^64; one table a base, as long as needed."""
    base = int(base)
    if base not in _POWERS or len(_POWERS[base][0]) < count:
        def table(factor: int) -> np.ndarray:
            out = np.full(max(1 << 16, count + count // 8), factor, np.uint64)
            out[0] = 1
            return np.cumprod(out, out=out)
        _POWERS[base] = table(base), table(pow(base, -1, 2**64))
    return _POWERS[base]


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PIECE_BYTES of text each, or a single row."""
    offsets = _buffers(batch.column(batch.schema.get_field_index(text)))[1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]:bounds[-1]], bounds - bounds[0]


def split(column: pa.Array) -> Words:
    data, offsets = _buffers(column)
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    here, before = inside[1:], inside[:-1]
    # A word also ends where its text ends.
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(here & (~before | cut))
    ends = np.flatnonzero(before & (~here | cut))
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words, fold_case: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; ``fold_case`` takes A-Z as a-z."""
    up, down = powers(_BYTE_BASE, len(words.data) + 1)
    values = (_FOLDED_VALUES if fold_case else _BYTE_VALUES)[words.data]
    values *= up[:len(values)]
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return mix((total[words.end] - total[words.start]) * down[words.start])


def run_hashes(hashes: np.ndarray, length: int, base: np.uint64 = WORD_BASE) -> np.ndarray:
    """Hashes of all runs of ``length`` consecutive words."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(base, len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    return mix((total[length:] - total[:count]) * down[:count], length)


def span_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = WORD_BASE) -> np.ndarray:
    """Hashes of the runs of words from ``start`` to before ``end``."""
    up, down = powers(base, len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * SECOND_BASE)


def shingle_set(hashes: np.ndarray, length: int) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, an empty one has none."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    return np.unique(run_hashes(hashes, min(length, len(hashes))))
