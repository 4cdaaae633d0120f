"""Hashes of the words and lines of many texts at once, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Byte table: white space that separates words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            p = np.full(max(n, 1 << 18), np.uint64(factor), dtype=np.uint64)
            p[0] = 1
            both.append(np.cumprod(p, dtype=np.uint64))
        _POWERS[base] = (both[0], both[1])
    return _POWERS[base]


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers spread evenly (a one-to-one map)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Spans:
    """Prefix sums over symbols that give a 64-bit hash of any span of them."""

    def __init__(self, symbols: np.ndarray, second: bool = False):
        up, self._down = _powers(_BASES[second], len(symbols) + 1)
        weighted = (symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)]
        self._sums = np.concatenate([[np.uint64(0)], np.cumsum(weighted, dtype=np.uint64)])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end)."""
        return mixed((self._sums[end] - self._sums[start]) * self._down[start])


class Texts:
    """The UTF-8 bytes of texts, or their code points, each text followed by a line feed."""

    def __init__(self, texts: list[str | None], lower: bool = False, wide: bool = False):
        code, kind = ("utf-32-le", np.uint32) if wide else ("utf-8", np.uint8)
        parts = [(t or "").encode(code, "surrogatepass") for t in texts]
        feed = "\n".encode(code)
        self.symbols = np.frombuffer(feed.join(parts) + feed, dtype=kind)
        if lower:
            self.symbols = _LOWER[self.symbols]
        self.n = len(parts)
        self.lengths = np.fromiter(map(len, parts), dtype=np.int64, count=self.n) // len(feed)
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1
        self._spans: Spans | None = None

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        self._spans = self._spans or Spans(self.symbols)
        return self._spans.hashes(start, end)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, start and end of every word (byte texts only)."""
        edge = np.flatnonzero(np.diff(SPACE[self.symbols], prepend=True))
        start, end = edge[0::2], edge[1::2]
        return np.searchsorted(self.starts, start, side="right") - 1, start, end

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, start and end of every line, without its line feed."""
        end = np.flatnonzero(self.symbols == 10)
        start = np.concatenate([[0], end[:-1] + 1]).astype(np.int64) if len(end) else end
        return np.searchsorted(self.starts, start, side="right") - 1, start, end


def chunks(texts: list[str | None], most_chars: int = 1 << 18):
    """(first index, texts) in pieces of about ``most_chars`` characters, one text at least."""
    first, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t or "") > most_chars:
            yield first, texts[first:k]
            first, size = k, 0
        size += len(t or "")
    if first < len(texts):
        yield first, texts[first:]
