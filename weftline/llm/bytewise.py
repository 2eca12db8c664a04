"""Words and hashes of many texts at once, on their UTF-8 bytes with numpy."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte, and an odd multiplier: a word's hash is the sum of value * multiplier ** place.
BYTE_VALUE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finish of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int, base: np.uint64 = MULTIPLIER) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, a newline after each, and where each text begins (and one more: the end)."""
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return buf, np.concatenate([[0], np.cumsum(size)])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z lowered, in order; and how many words each text has."""
    buf, begin = joined(texts)
    if not len(buf):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    space = IS_SPACE[buf]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    ends = np.flatnonzero(space & ~before)
    body = buf[starts[0] :]
    place = np.arange(starts[0], len(buf)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(buf)]])))
    longest = int((ends - starts).max())
    value = BYTE_VALUE[LOWER[body]] * powers(longest + 1)[np.minimum(place, longest)]
    value[space[starts[0] :]] = 0
    h = np.add.reduceat(value, starts - starts[0])
    return mix(h + (ends - starts).astype(np.uint64)), np.diff(np.searchsorted(starts, begin))


def in_pieces(texts: list, limit: int = 2_000_000):
    """Slices of ``texts`` with about ``limit`` bytes each."""
    first = size = 0
    for k, t in enumerate(texts):
        size += len(t) if t else 1
        if size >= limit or k == len(texts) - 1:
            yield slice(first, k + 1)
            first, size = k + 1, 0


def give_back(out=None):
    """Hand free memory of this Python worker, Arrow's too, back to the system, which a worker that lives on would keep; ``out`` comes back as it is."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
    return out


def giving_back(run):
    """``run`` over a task's batches; its variables are gone before the worker hands their memory back."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def in_slices(batch, column: str, limit: int = 4_000_000):
    """Slices of an Arrow batch with about ``limit`` bytes in one of its columns each, so that few of its values become Python objects at once."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    first = 0
    while first < batch.num_rows:
        before = int(size[first - 1]) if first else 0
        stop = max(first + 1, int(np.searchsorted(size, before + limit)))
        yield batch.slice(first, stop - first)
        first = stop
