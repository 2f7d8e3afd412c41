"""Vectorised text helpers for Arrow tasks: words, hashes and line spans of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Words are runs of anything but these bytes.
SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], np.uint8)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[SPACES] = True
# Continuation bytes of UTF-8 do not begin a code point.
BEGINS_CHAR = (np.arange(256) & 0xC0) != 0x80
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

CHUNK_BYTES = 1 << 18  # some ten arrays of this many words live at once in a task
_POWER = np.uint64(0x9E3779B97F4A7C15)


class Chunk(NamedTuple):
    """Rows ``first`` to ``last`` of a batch: their bytes and where each text begins and ends."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Split a text column into runs of whole texts of about ``limit`` bytes; null counts as empty.

    A text longer than the limit is a run of its own, so memory follows the longest text.
    """
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Chunk(
            first,
            last,
            raw[bounds[first] : bounds[last]],
            bounds[first : last + 1] - bounds[first],
        )
        first = last


class Spans(NamedTuple):
    """Byte spans, and for each text the range of its spans (``of[d]`` to ``of[d + 1]``)."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray


def spans(solid: np.ndarray, bounds: np.ndarray) -> Spans:
    """Maximal runs of ``solid`` bytes; a text's bounds end a run."""
    begins, finishes = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    finishes[:-1] &= ~solid[1:]
    inner = bounds[(bounds > 0) & (bounds < len(solid))]
    begins[inner] = solid[inner]
    finishes[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begins)
    return Spans(starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, bounds))


def words(chunk: Chunk) -> Spans:
    return spans(~IS_SPACE[chunk.data], chunk.bounds)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _POWER)
_BASE = _POWER | np.uint64(1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(max(n, CHUNK_BYTES + 1), base)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash: the hash of any span is a difference of two of its values."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * _power_tables(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, at: Spans) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    inverse = _power_tables(len(prefix))[1]
    sums = (prefix[at.ends] - prefix[at.starts]) * inverse[at.starts]
    return mix(sums + (at.ends - at.starts).astype(np.uint64) * _POWER)


def totals(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between successive bounds."""
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def owners(of: np.ndarray) -> np.ndarray:
    """For each span the number of its text."""
    return np.repeat(np.arange(len(of) - 1), np.diff(of))


def distinct_per_text(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Number of different values of each text, by 40 bits of their hash."""
    if len(values) == 0:
        return np.zeros(len(of) - 1, np.int64)
    whose = owners(of).astype(np.uint64)
    keys = np.sort((whose << np.uint64(40)) | (values >> np.uint64(24)))
    fresh = np.ones(len(keys), bool)
    fresh[1:] = keys[1:] != keys[:-1]
    return totals(fresh, of)


def class_counts(codes: np.ndarray, bounds: np.ndarray, n_classes: int) -> np.ndarray:
    """How many bytes of each class every text has; ``codes`` holds a class for each byte."""
    n = len(bounds) - 1
    cell = np.repeat(np.arange(n) * n_classes, np.diff(bounds)) + codes
    return np.bincount(cell, minlength=n * n_classes).reshape(n, n_classes)
