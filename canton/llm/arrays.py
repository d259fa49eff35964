"""Arrow and numpy helpers shared by the text operators.

Tasks see Arrow batches; a batch is cut into slices of bounded text size so
that the numpy arrays of a slice stay small whatever the batch holds.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Row slices of at most about SLICE_BYTES of ``column``, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, base + SLICE_BYTES, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def release_memory() -> None:
    """Memory that this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim:
        trim(0)


def give_back(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; after the last one, memory that the task freed goes back to the system.

    A worker outlives its task, and its unused memory would count beside the next stages'.
    """
    yield from batches
    release_memory()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets of the texts; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept by the worker."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """n + 1 polynomial prefix sums of the bytes."""
    up, _ = powers(max(len(raw), 1))
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of raw[start:stop], wherever it stands."""
    _, down = powers(max(len(prefix), 1))
    return mix((prefix[stop] - prefix[start]) * down[start] + (stop - start).astype(np.uint64))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes above the space), first word of each text.

    The third array has n + 1 entries: text i owns words first[i]:first[i + 1].
    """
    solid = np.zeros(len(raw) + 1, bool)
    np.greater(raw, 32, out=solid[:-1])
    begins = solid[:-1].copy()
    begins[1:] &= ~solid[:-2]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    ends_at = ~solid[1:]
    ends_at &= solid[:-1]
    ends_at[inner - 1] = solid[inner - 1]
    ends = np.flatnonzero(ends_at) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_sets(
    column: pa.Array, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of ``size`` consecutive words, ascending within each text.

    Returns the hashes and n + 1 offsets. A text with fewer words has the one
    shingle of all its words; a text without words has none.
    """
    raw, offsets = utf8(column)
    starts, ends, first = words(raw, offsets)
    hashes = span_hash(prefix_hash(raw), starts, ends)
    count = np.diff(first)
    shingles = np.maximum(count - size + 1, (count > 0).astype(count.dtype))
    text = np.repeat(np.arange(len(count)), shingles)
    begin = np.arange(len(text)) - np.repeat(np.cumsum(shingles) - shingles, shingles)
    begin += first[text]
    last = first[text + 1]
    value = np.zeros(len(text), np.uint64)
    for k in range(size):
        at = begin + k
        inside = at < last
        part = hashes[np.where(inside, at, 0)] if len(hashes) else value
        value = mix(value * _BASE + np.where(inside, part, np.uint64(k + 1)))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    text, value = text[keep], value[keep]
    return value, np.searchsorted(text, np.arange(len(count) + 1))


def binary_column(parts: Iterable[bytes]) -> pa.Array:
    return pa.array(list(parts), pa.binary())
