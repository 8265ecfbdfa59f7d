"""Words of many texts at once, as positions and 64-bit hashes over the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes that separate words: white space (tab to carriage return, blank)
WHITE = np.isin(np.arange(256), [*range(0x09, 0x0E), 0x20])
#: bytes that separate words where only letters and digits count; bytes from 0x80 are letters
PUNCTUATION = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
#: bytes of text that one numpy step handles; a longer text is a step of its own
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _codes() -> np.ndarray:
    folded = np.arange(256, dtype=np.uint64)
    folded[65:91] += np.uint64(32)  # A-Z count as a-z
    return mix((folded + np.uint64(1)) * np.uint64(_BASE))


CODES = _codes()


class _Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown to the longest span asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 1 << 16)
            made = []
            for base in (_BASE, pow(_BASE, -1, 1 << 64)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                made.append(np.cumprod(steps, dtype=np.uint64))
            self.up, self.down = made
        return self.up[:n], self.down[:n]


POWERS = _Powers()


def pieces(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cuts a string column into runs of whole texts of about ``size`` bytes.

    Yields ``(first row, bytes, offsets)``; a null counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    places = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(places, places[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[places[first] : places[last]], places[first : last + 1] - places[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the number of the first word (one more at the end)."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    edge = offsets[:-1][filled]
    begins[edge] = inside[edge]
    edge = offsets[1:][filled] - 1
    stops[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased: a polynomial over byte codes, then mixed.

    Prefix sums give all words of a step at once. Words are hashed in steps of
    ``SLICE_BYTES``, so memory follows the step, not the text.
    """
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SLICE_BYTES, side="right")))
        low, high = int(starts[a]), int(ends[b - 1])
        up, down = POWERS.get(high - low)
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(CODES[data[low:high]] * up, out=total[1:])
        s, e = starts[a:b] - low, ends[a:b] - low
        out[a:b] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        a = b
    return out


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive hashes; runs that cross a text's end are the caller's to mask."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + h[j : j + n]
    return mix(out)
