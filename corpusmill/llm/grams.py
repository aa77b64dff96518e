"""Vectorised hashes over the texts of an Arrow batch: words, windows of words, windows of bytes.

A window's hash comes from running sums: with odd B, the sum of T[x_i] * B^i over a range, times the inverse power of
its start, depends on the range's content alone (modulo 2^64). A last mix spreads it over all bits. Hashes are 64 bits.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: The white space of the word rule, tab to carriage return and blank.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True



class _Powers(dict):
    """Kept per process: functions that travel to executors take it along empty."""

    def __reduce__(self):
        return _Powers, ()


_powers = _Powers()


def powers(n: int, base: int) -> np.ndarray:
    """base^0 ... base^(n-1), kept for the next batch."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values; another seed gives an independent value."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts and the offsets of each text; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def running(values: np.ndarray) -> np.ndarray:
    """Running sums from which `window` takes the hash of any range."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values), _BASE), out=out[1:])
    return out


def window(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = powers(len(sums), _INVERSE)
    return mix((sums[end] - sums[start]) * inverse[start])


def every_window(sums: np.ndarray, size: int) -> np.ndarray:
    """`window` for all starts, without gathering."""
    n = max(len(sums) - size, 0)
    out = sums[size:] - sums[:n]
    out *= powers(len(sums), _INVERSE)[:n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


class Words:
    """The words of a batch of texts: `start` and `end` bytes, `text` number, `hash`; `first[t]` numbers the first of text t."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        n = len(data)
        inside = ~separators[data]
        new = np.zeros(n + 1, bool)
        new[offsets] = True  # a text's end ends its last word
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | new[:n]))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | new[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(offsets) - 1), self.count)
        self.hash = window(running(_TABLE[data]), self.start, self.end) if n else np.zeros(0, np.uint64)

    def windows(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words at which a window of `size` words of one text starts, and the windows' hashes."""
        at = starts(self.first, size)
        return at, mix(window(running(mix(self.hash, seed)), at, at + size), seed)


def starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions from which `size` items of one text follow; first: where the texts begin, and the end."""
    room = np.maximum(np.diff(first) - size + 1, 0)
    total = int(room.sum())
    out = np.arange(total) + np.repeat(first[:-1] - (np.cumsum(room) - room), room)
    return out.astype(np.int64)


def covered(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n items are covered by windows of `size` that start at `at`."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return np.cumsum(edge[:-1]) > 0
