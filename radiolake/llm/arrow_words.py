"""Words of Arrow columns, numbered in numpy without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACES = np.zeros(256, bool)
_SPACES[list(b" \t\n\r\x0b\x0c")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def offsets_of(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]


def bytes_of(array: pa.Array) -> np.ndarray:
    return np.frombuffer(array.buffers()[2] or b"", np.uint8)


def array_of(bounds: np.ndarray, letters: np.ndarray) -> pa.Array:
    """Strings that lie one after the other in `letters`; each ends where the next begins."""
    held = [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(letters))]
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, held)


def numbered_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of all texts as numbers, the different words, and where each text's words begin and end.

    Words are runs of bytes other than space and the controls from tab to carriage return, with A-Z
    as a-z if `lower`. There is one text at least, and none is NULL.
    """
    offsets = offsets_of(texts)
    raw = bytes_of(texts)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = ~_SPACES.take(raw)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    letters = raw[inside]
    if lower:
        letters = _LOWER.take(letters)
    coded = array_of(np.append(np.cumsum(inside)[starts] - 1, len(letters)), letters).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary, np.searchsorted(starts, offsets)


def portions(texts: pa.Array, size: int) -> list[tuple[int, int]]:
    """First and last place of runs of texts of about `size` bytes in all, one text at least."""
    ends, out, first = np.cumsum(np.diff(offsets_of(texts)), dtype=np.int64), [], 0
    while first < len(texts):
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        out.append((first, last))
        first = last
    return out
