"""Content-defined anchors: which windows of a text could repeat elsewhere, decided by one hash per some forty bytes.

Every window of `length` bytes picks the position in it whose k-gram has the least hash (leftmost of equals). Equal windows pick the
same one, so windows can only match under one k-gram hash. Consecutive windows with one pick form a region.
"""

from __future__ import annotations

import numpy as np
import xxhash

LENGTH, GRAM, SEGMENT = 100, 28, 1 << 18
BASE = 0x9E3779B97F4A7C15
LOW = np.uint64((1 << 21) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Powers:
    """Powers of the base and of its inverse modulo 2^64, and a random number per byte."""

    def __init__(self, n: int = SEGMENT + 4096):
        inverse = pow(BASE, -1, 1 << 64)
        self.up, self.down = (np.concatenate([np.ones(1, "u8"), np.cumprod(np.full(n, b, "u8"), dtype="u8")]) for b in (BASE, inverse))
        self.byte = mix(np.arange(1, 257, dtype="u8") * np.uint64(0xA24BAED4963EE407))


_powers: list[Powers] = []


def powers() -> Powers:
    if not _powers:
        _powers.append(Powers())
    return _powers[0]


def regions(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Regions of joined texts: (k-gram hash, first window, bytes). data: bytes; ends: where each text ends.

    At most SEGMENT + 4096 bytes; a region covers data[first : first + bytes]. With a gram of the whole length every window is one.
    """
    n, p = len(data), powers()
    if n < length:
        return np.zeros(0, "u8"), np.zeros(0, "i8"), np.zeros(0, "i8")
    prefix = np.zeros(n + 1, "u8")
    np.cumsum(p.byte[data] * p.up[:n], out=prefix[1:])
    h = mix((prefix[gram:] - prefix[:-gram]) * p.down[: n - gram + 1])
    key = (h & ~LOW) | np.arange(len(h), dtype="u8")
    span, width = 1, length - gram + 1
    least = key
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    pick = (least & LOW).astype("i8")  # of window i, for all n - length + 1 windows
    start = np.arange(len(pick))
    end_of = ends[np.searchsorted(ends, start, side="right")]
    valid = start + length <= end_of
    new = np.empty(len(pick), bool)
    new[0] = True
    new[1:] = (pick[1:] != pick[:-1]) | (end_of[1:] != end_of[:-1])
    first = np.flatnonzero(new & valid)
    runs = np.cumsum(new)[valid]
    last = start[valid][np.concatenate([runs[1:] != runs[:-1], [True]])] if len(runs) else first
    return h[pick[first]], first, last - first + length


def contents(data: bytes, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit hash of each region's bytes, as two signed numbers."""
    digests = [xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(first.tolist(), (first + size).tolist())]
    pairs = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def changes(*keys: np.ndarray) -> np.ndarray:
    """Where any of the keys differs from the row before; the first row does."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def joined(keys: tuple[np.ndarray, ...], starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, ...]:
    """Union of the intervals of each key: (*keys, starts, stops) of the maximal ones, in order."""
    if not len(starts):
        return *keys, starts, stops
    order = np.lexsort((starts, *reversed(keys)))
    keys, starts, stops = tuple(k[order] for k in keys), starts[order], stops[order]
    number = np.cumsum(changes(*keys)) - 1 if keys else np.zeros(len(starts), "i8")
    far = int(stops.max()) + 1
    reach = np.maximum.accumulate(stops + number * far)
    new = np.concatenate([[True], (number[1:] != number[:-1]) | (starts[1:] + number[1:] * far > reach[:-1])])
    at = np.flatnonzero(new)
    return *(k[at] for k in keys), starts[at], reach[np.concatenate([at[1:] - 1, [len(starts) - 1]])] - number[at] * far
