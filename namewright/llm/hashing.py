"""Vectorised hashes of words and word runs for many documents at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of an odd base modulo 2**64, and those of its inverse."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b, np.uint64)]).cumprod() for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


_POWERS = [_Powers(b) for b in _BASES]


def run_hashes(values: np.ndarray, first: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """64-bit hashes of the runs values[first:stop]; equal runs have equal hashes wherever they stand."""
    up, down = _POWERS[base].of(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[stop] - sums[first]) * down[first] + (stop - first).astype(np.uint64))


def chunks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about CHUNK_BYTES (one text at least)."""
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size < CHUNK_BYTES):
            size += len(texts[stop] or b"")
            stop += 1
        yield at, stop
        at = stop


class Words:
    """The words (runs of bytes that are no separators) of several texts, side by side.

    doc: index of each word's text; start, stop: byte positions in ``data``, where text i
    begins at ``base[i]``; h: 64-bit hashes of the words' bytes."""

    def __init__(self, texts: list[bytes | None], separator: np.ndarray, fold: bytes | None = None):
        joined = b" ".join([t or b"" for t in texts])
        if fold:
            joined = joined.translate(fold)
        self.data = np.frombuffer(joined, np.uint8)
        lengths = np.array([len(t or b"") + 1 for t in texts], np.int64)
        self.base = np.concatenate([[0], lengths.cumsum()])[:-1]
        inside = np.zeros(len(self.data) + 2, np.int8)
        inside[1:-1] = ~separator[self.data]
        step = np.diff(inside)
        self.start, self.stop = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.doc = np.searchsorted(self.base, self.start, "right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))  # of each text's words
        self.h = run_hashes(self.data.astype(np.uint64) + np.uint64(1), self.start, self.stop, 0)


WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


_PART = 1 << 22


def window_minima(values: np.ndarray, gram: int, window: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every ``window`` consecutive grams (runs of ``gram`` values; fewer if the text is short) the rightmost one with the smallest hash.

    Yields parts (at, best, h): best[i] is the gram chosen for window at + i, relative to ``at``, and h the hashes of the part's grams.
    Hashes are compared by their upper 40 bits."""
    grams = max(1, len(values) - gram + 1)
    places = np.uint64((1 << 24) - 1)
    for at in range(0, max(1, grams - window + 1), _PART):
        stop = min(grams, at + _PART + window - 1)
        first = np.arange(stop - at)
        part = values[at : min(len(values), stop + gram - 1)]
        h = run_hashes(part, first, np.minimum(first + gram, len(part)), 3)
        key = (h & ~places) | (places - first.astype(np.uint64))
        width, size, best = min(window, len(key)), 1, key
        while 2 * size <= width:
            best = np.minimum(best[:-size], best[size:])
            size *= 2
        if size < width:
            best = np.minimum(best[: len(key) - width + 1], best[width - size :])
        yield at, (places - (best & places)).astype(np.int64), h
