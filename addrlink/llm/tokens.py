"""Words of many texts at once, as numpy arrays over Arrow buffers.

A slice of an Arrow string column is looked at as one run of UTF-8 bytes: word
borders, 64-bit word hashes and hashes of word windows come from whole-array
operations, with no Python work per word. Nulls count as empty texts.

A word's hash sums a mixed term for each byte and place, a sequence's hash mixes
those of two overlapping runs of a power of two words; neither is a polynomial, so
no family of texts collides by its form. Equal words have equal hashes in every
task, run and machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1_000_000


def _splitmix(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


VALUES = _splitmix(256, 0xA11CE)
LOWER_VALUES = VALUES.copy()
LOWER_VALUES[65:91] = VALUES[97:123]
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACED = np.ones(256, bool)  # bytes of words [^\x20\x09-\x0D]+
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower-cased
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


_places = mix(np.arange(1, 4097, dtype=U))  # a factor for each place in a word, grown when a longer word comes


def places(n: int) -> np.ndarray:
    global _places
    if len(_places) < n:
        _places = mix(np.arange(1, (1 << (n - 1).bit_length()) + 1, dtype=U))
    return _places[: max(n, 1)] | U(1)


def terms(values: np.ndarray, data: np.ndarray, place: np.ndarray, out: np.ndarray) -> None:
    """What each byte adds to its word's hash, in runs that fit a processor's cache."""
    factor = places(int(place.max()) + 1 if len(place) else 1)
    for k in range(0, len(data), 32_768):
        s = slice(k, k + 32_768)
        t = values[data[s]]
        t *= factor[place[s]]
        t ^= t >> U(32)
        t *= U(0xD6E8FEB86659FD93)
        t ^= t >> U(29)
        out[s] = t


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = 20_000) -> Iterator[tuple[int, pa.Array]]:
    """Runs of at most ``rows`` rows with at most ``limit`` bytes of text (a longer text is a run of its own)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    at, offsets = 0, np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    while at < len(texts):
        to = min(at + rows, max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1))
        yield at, texts.slice(at, to - at)
        at = to


class Words:
    """Words of a slice: ``start`` and ``end`` (bytes), ``hash``, and ``first[d]:first[d + 1]``, the words of text d."""

    def __init__(self, texts: pa.Array, of: np.ndarray = SPACED, lower: bool = False, hashes: bool = True):
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        base = int(offsets[0])
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[base : int(offsets[-1])] if raw is not None and raw.size else np.zeros(0, np.uint8)
        offsets = offsets - base
        inside = of[data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        full = offsets[:-1][np.diff(offsets) > 0]
        before[full] = False
        after[full[1:] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.offsets, self.data, self.n = offsets, data, len(self.start)
        self._values, self._inside, self._runs = LOWER_VALUES if lower else VALUES, inside, {}
        self.hash = self._hash(self.end - self.start, 0) if hashes else None

    def _sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of the terms of all bytes in words, and where each word starts in them."""
        size = self.end - self.start
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum()), dtype=np.int32) - np.repeat(at.astype(np.int32), size)
        sums = np.zeros(len(place) + 1, U)
        terms(self._values, self.data[self._inside], place, sums[1:])
        np.cumsum(sums, out=sums)
        return sums, at

    def _hash(self, size: np.ndarray, tag: int) -> np.ndarray:
        sums, at = self._sums()
        return mix(sums[at + size] - sums[at] + size.astype(U) + U(tag))

    def second(self) -> np.ndarray:
        """Hashes of the words that are independent of ``hash``."""
        held = self._values
        self._values = mix(held ^ U(0x5851F42D4C957F2D))
        out = self._hash(self.end - self.start, 0)
        self._values = held
        return out

    def text(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Words of at least ``size`` bytes and hashes of their first ``size`` bytes."""
        at = np.flatnonzero(self.end - self.start >= size)
        return at, self._hash(np.minimum(self.end - self.start, size), size << 32)[at]

    def spans(self, at: np.ndarray, to: np.ndarray, second: bool = False) -> np.ndarray:
        """Hashes of the word sequences at[i]:to[i], of one word at least."""
        size = np.asarray(to) - at
        power = np.frexp(size.astype(float))[1] - 1
        out = np.zeros(len(size), U)
        for p in np.unique(power).tolist():
            run, i = self._run(p, second), power == p
            out[i] = mix(run[at[i]] + size[i].astype(U) * U(0xC2B2AE3D27D4EB4F) ^ mix(run[to[i] - (1 << p)]))
        return out

    def _run(self, power: int, second: bool) -> np.ndarray:
        """A hash of the 2**power words from each word on (of use only where they lie in one text)."""
        if (power, second) not in self._runs:
            if not power:
                self._runs[power, second] = self.second() if second else self.hash
            else:
                half = self._run(power - 1, second)
                other = np.zeros_like(half)
                k = 1 << power - 1
                other[: max(0, len(half) - k)] = half[k:]
                self._runs[power, second] = mix(half * U(0x9FB21C651E98DF25) + mix(other))
        return self._runs[power, second]

    def window_starts(self, k: int) -> np.ndarray:
        """First words of all windows of k words that lie in one text."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(self.n)
        return np.flatnonzero(left >= k)

    def word(self, i: int, lower: bool = False) -> bytes:
        w = self.data[self.start[i] : self.end[i]]
        return (LOWER[w] if lower else w).tobytes()


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as int64, for Arrow's long."""
    return x.view(np.int64)
