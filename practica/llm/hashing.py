"""Word hashes of whole texts, without a Python step for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from practica.llm.tokens import worker_cache

# An odd 64-bit multiplier, its inverse modulo 2**64, mixing constants.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX_A, _MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
# White space of words: space and U+0009..U+000D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
GROUP_BYTES = 1 << 18


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(_MIX_A)
    h ^= h >> np.uint64(27)
    h *= np.uint64(_MIX_B)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, out=out)


class WordHasher:
    """64-bit hashes of the words (runs of all but white space) of texts."""

    def __init__(self):
        self.up, self.down = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            size = 1 << n.bit_length()
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, number of words of each text)."""
        data = [t.encode("utf-8", "replace") for t in texts]
        sizes = np.array([len(d) + 1 for d in data], np.int64)
        b = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
        self._grow(len(b) + 1)
        space = _SPACE[b]
        edge = np.diff(space.view(np.int8), prepend=1)
        start, end = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.up[:len(b)], out=total[1:])
        h = (total[end] - total[start]) * self.down[start]
        h = mix(h + (end - start).astype(np.uint64) * np.uint64(_MIX_A))
        counts = np.diff(np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)])))
        return h, counts

    def groups(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(index of the first text, hashes, words of each text), about
        ``GROUP_BYTES`` at a time; a text is never divided."""
        first, size = 0, 0
        for i, t in enumerate(texts):
            if size and size + len(t) > GROUP_BYTES:
                yield first, *self.words(texts[first:i])
                first, size = i, 0
            size += len(t)
        if first < len(texts):
            yield first, *self.words(texts[first:])


def word_hasher() -> WordHasher:
    """The process's hasher."""
    cache = worker_cache().__dict__
    if "hasher" not in cache:
        cache["hasher"] = WordHasher()
    return cache["hasher"]
