"""Arrow batches of text as flat numpy arrays: the shared helper of the Python-side operators.

Texts stay in Arrow's own layout (one byte buffer plus offsets). A batch is cut
into chunks of a few MB, so a task's memory is bounded by the chunk (or by one
text, when a single text is longer).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

#: The white space that separates words: space and \x09-\x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of ``column`` each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(size, dtype=np.int64) - size) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
        pa.default_memory_pool().release_unused()  # a reused worker would hold the largest batch's memory


def text_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array end to end, and the offsets of its rows; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()) if not pa.types.is_large_string(arr.type) else arr
    if arr.null_count:
        arr = pc.fill_null(arr, "")
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and row of every word ``[^\\x20\\x09-\\x0D]+``, in order."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - start
    return start, length, np.searchsorted(off, start, "right") - 1


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i] + length[i] - 1, for all i end to end."""
    end = np.cumsum(length)
    total = int(end[-1]) if len(end) else 0
    return np.repeat(start - (end - length), length) + np.arange(total)


def codes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """Equal byte strings get equal codes 0, 1, ...; also returns the distinct strings by code."""
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=off[1:])
    whole = len(start) and int(start[0] + off[-1]) == int(start[-1] + length[-1])
    flat = data[start[0] : start[0] + off[-1]] if whole else data[ragged(start, length)]
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(flat))])
    enc = arr.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary


def binary_parts(arr: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large binary array."""
    if not len(arr):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    off = np.frombuffer(off, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def strings(flat: np.ndarray, off: np.ndarray) -> pa.Array:
    """A string array over byte buffer and offsets (bytes must be UTF-8)."""
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(np.ascontiguousarray(flat))).cast(pa.string())
