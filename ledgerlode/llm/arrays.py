"""Numpy helpers for whole columns of text inside a task: words, digests of words, ranges, packing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

U64 = np.uint64
#: The words of most operators end at these bytes: space, and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
#: Bytes of text worked on at once, which takes about 70 times as much memory; results do not depend on it.
_SLICE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_STEP = 0x9E3779B97F4A7C15
BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_STEP))
#: Ranges have two polynomial digests modulo this prime. A power of two would make texts of a doubling structure collide.
_PRIME = (1 << 31) - 1
_BASES = (0x2545F491 % _PRIME, 0x41C64E6D % _PRIME)
_P, _BITS = U64(_PRIME), U64(31)
_powers: dict[int, np.ndarray] = {}


def _below(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^63 to equal ones modulo the prime, below 2^31 + 2."""
    x = (x & _P) + (x >> _BITS)
    return (x & _P) + (x >> _BITS)


def _table(base: int, n: int) -> np.ndarray:
    """Powers of a base modulo the prime, kept per worker process."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, U64)
        while len(have) < max(n, 1 << 16):
            have = np.concatenate((have, _below(have * U64(pow(base, len(have), _PRIME)))))
        _powers[base] = have
    return have[:n]


def prefix_digests(values: np.ndarray) -> list[np.ndarray]:
    """Running digests, 31 bits of each value in either; ``span_digests`` takes any range out of them."""
    out = []
    for base, shift in zip(_BASES, (33, 2)):
        term = _below(((values >> U64(shift)) & _P) * _table(base, len(values)))
        running = np.zeros(len(values) + 1, U64)
        np.cumsum(term, out=running[1:])
        out.append(running)
    return out


def span_digests(prefix: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit digests of the ranges [start, end): equal for equal contents wherever they stand."""
    out = (ends - starts).astype(U64) * U64(_STEP)
    for running, base, shift in zip(prefix, _BASES, (0, 32)):
        inverse = _table(pow(base, -1, _PRIME), len(running))
        part = _below(_below(running[ends] - running[starts]) * inverse[starts])
        part -= _P * (part >= _P)
        out += part << U64(shift)
    return mix(out)


def byte_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_digests(prefix_digests(BYTE[data]), starts, ends)


def sequence_digests(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Digests of ranges of word digests."""
    return span_digests(prefix_digests(words), starts, ends)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a column and the offsets of its rows; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def slices(data: np.ndarray, offsets: np.ndarray, limit: int = _SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about half a MB, at least one row each, so that working memory stays small."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def find_words(data: np.ndarray, offsets: np.ndarray,
               separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and the offsets of each row's words in them."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    gap = separator[data]
    filled = offsets[:-1][offsets[:-1] < offsets[1:]]
    before = np.empty(len(data), bool)
    before[1:] = gap[:-1]
    before[filled] = True
    starts = np.flatnonzero(before & ~gap)
    after = np.empty(len(data), bool)
    after[:-1] = gap[1:]
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = True
    ends = np.flatnonzero(after & ~gap) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the ranges start, start + 1, … one after the other."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of the positions 0 to n - 1 lie in any of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:-1]) > 0


def pack(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Columns of numbers as one compressed value. The reader knows the types."""
    head = np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=level).compress(
        head + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    sizes = np.frombuffer(raw, np.int64, n, 8)
    at = 8 * (n + 1)
    out = []
    for size, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def give_back() -> None:
    """Return freed memory to the system. Workers live on between tasks, and what their allocators keep adds to
    the memory of the executor while other stages run."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def by_batch(work: Callable[[pa.RecordBatch], pa.RecordBatch | list[pa.RecordBatch]]):
    """A function for mapInArrow from one that takes a batch. No batch is held while the next one is read."""
    def run(batches):
        try:
            for batch in batches:
                if batch.num_rows:
                    out = work(batch)
                    yield from (out if isinstance(out, list) else [out])
                    del out
                del batch
        finally:
            give_back()
    return run


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)
