"""Words of many texts at once, cut and hashed in numpy straight from Arrow's buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so powers have inverses modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_PIECE = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

SYMBOLS = np.zeros(256, dtype=bool)  # every ASCII character but letters and digits
SYMBOLS[:128] = [not chr(c).isalnum() for c in range(128)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """Words of a few texts. ``start`` and ``end`` are byte offsets in ``data``, which is lower-cased in ASCII;
    text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, texts: pa.Array, separators: np.ndarray):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        size = int(offsets[-1] - offsets[0])
        buffer = texts.buffers()[2]
        raw = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if size else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = LOWER[raw]
        inside = ~separators[raw]
        edge = np.zeros(size + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], inside[:-1])) & ~edge[:-1] if size else inside
        after = np.concatenate((inside[1:], [False])) & ~edge[1:] if size else inside
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, ends: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the words, or of their beginnings up to ``ends``."""
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            values = self.data.astype(np.uint64) + np.uint64(1)
            np.cumsum(values * powers(_BASE, len(self.data)), out=self._sums[1:])
            self._back = powers(_INVERSE, len(self.data) + 1)
        until = self.end if ends is None else ends
        return mixed((self._sums[until] - self._sums[self.start]) * self._back[self.start])

    def of(self, text: int) -> slice:
        return slice(int(self.first[text]), int(self.first[text + 1]))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that each holds about a megabyte of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(batch.column(column).cast(pa.large_string())).fill_null(0))
        group = np.cumsum(sizes) // _PIECE
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` consecutive word hashes."""
    if len(words) < k:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = out * _BASE + words[i : len(words) - k + 1 + i]
    return mixed(out)
