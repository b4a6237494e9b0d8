"""Words of many texts at once, as positions and 64-bit hashes in one byte buffer.

Texts are UTF-8. A hash is a sum of random table values times odd powers, read off one running
sum, then mixed; equal byte strings have equal hashes in every process. Two different words
share one with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
# Bytes hashed at once; a longer word gets a window of its own.
WINDOW = 1 << 18
# Bytes of text whose arrays are in memory at once where many workers live side by side; arrays take many times their size.
PIECE = 1 << 18

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _splitmix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


with np.errstate(over="ignore"):
    _VALUE = _splitmix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 bits; one to one."""
    with np.errstate(over="ignore"):
        return _splitmix(x)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte buffer, and the offset at which each begins (one more at the end); null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``most_bytes`` of text, so that arrays over bytes stay small; a longer text is alone."""
    lengths = np.concatenate([[0], np.cumsum(np.asarray(_byte_lengths(batch.column(text))))])
    at = 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(lengths, lengths[at] + most_bytes, side="right")) - 1
        stop = min(max(stop, at + 1), batch.num_rows)
        yield batch.slice(at, stop - at)
        at = stop
    # Workers live on between stages; what Arrow has freed goes back to the machine.
    pa.default_memory_pool().release_unused()


def _byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def spans(buffer: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of non-separator bytes, and for each text the index of its first run."""
    if not len(buffer):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~separator[buffer]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[offsets < len(buffer)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[offsets > 0] - 1
    ends[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span; starts ascend."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            low = int(starts[at])
            stop = max(int(np.searchsorted(ends, low + WINDOW, side="right")), at + 1)
            high = int(ends[stop - 1])
            up, down = _powers(max(high - low, WINDOW))
            running = np.empty(high - low + 1, np.uint64)
            running[0] = 0
            np.cumsum(_VALUE[buffer[low:high]] * up[: high - low], out=running[1:])
            first = starts[at:stop] - low
            out[at:stop] = (running[ends[at:stop] - low] - running[first]) * down[first]
            at = stop
        return _splitmix(out + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values in ascending order, the first index of each, and where each value went.

    Sorts value and index packed into one word, which is several times faster than an index sort.
    """
    bits = max(1, int(len(values) - 1).bit_length())
    if not len(values):
        return values, np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = np.uint64((1 << bits) - 1)
    packed = np.sort((values & ~low) | np.arange(len(values), dtype=np.uint64))
    order = (packed & low).astype(np.int64)
    ranked = values[order]
    fresh = np.empty(len(values), bool)
    fresh[0] = True
    np.not_equal(ranked[1:], ranked[:-1], out=fresh[1:])
    if (ranked[1:] < ranked[:-1]).any():  # two values that differ in the packed-over bits only
        found, first, went = np.unique(values, return_index=True, return_inverse=True)
        return found, first, went.reshape(-1)
    went = np.empty(len(values), np.int64)
    went[order] = np.cumsum(fresh) - 1
    return ranked[fresh], order[fresh], went
