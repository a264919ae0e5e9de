"""Words and word shingles of whole texts as 64-bit hashes, for a batch of texts at a time.

A batch is one byte string; word bounds and hashes are array expressions over it, so no Python code runs per word.
Hashes are polynomials modulo 2**64 with an odd base, finished by a mixer; the same bytes always give the same hash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Texts of one array pass together hold about this many bytes; a longer text is a pass of its own.
PASS_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def passes(texts: Iterable[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as bytes), in portions of bounded size; a missing text is empty."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b"")
        size += len(held[-1])
        if size >= PASS_BYTES:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of some texts, A-Z in lower case.

    `hashes`: a hash per word; `starts`, `ends`: its bytes in `data`; `bounds`: word numbers at which texts begin
    (one more than there are texts); `begins`: where the texts begin in `data`.
    """

    def __init__(self, texts: list[bytes]):
        joined = b"\n".join(texts) + b"\n"
        self.data = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.begins = np.concatenate(([0], np.cumsum(lengths + 1)))[: len(texts)]
        gap = _SPACE[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.bounds = np.concatenate((np.searchsorted(self.starts, self.begins), [len(self.starts)]))
        inverse = pow(_BASE, -1, 1 << 64)
        sums = np.concatenate(
            (np.zeros(1, dtype=np.uint64), np.cumsum((_LOWER[self.data].astype(np.uint64) + np.uint64(1)) * _powers(len(self.data), _BASE), dtype=np.uint64))
        )
        back = _powers(len(self.data) + 1, inverse)
        raw = (sums[self.ends] - sums[self.starts]) * back[self.starts]
        self.hashes = mixed(raw ^ ((self.ends - self.starts).astype(np.uint64) << np.uint64(48)))


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of `size` words inside one text, bounds as in `Words`).

    A text with fewer words, but not none, has one shingle: all its words.
    """
    counts = np.diff(words.bounds)
    own = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(own)))
    first = np.repeat(words.bounds[:-1], own) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], own)
    last = np.repeat(words.bounds[1:], own)
    total = np.zeros(len(first), dtype=np.uint64)
    h = np.concatenate((words.hashes, np.zeros(size, dtype=np.uint64)))
    for j in range(size):
        factor = np.uint64(pow(0xD1342543DE82EF95, j + 1, 1 << 64))
        total += np.where(first + j < last, h[first + j] * factor + np.uint64(j + 1), np.uint64(0))
    return mixed(total), bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, with their bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    v, o = v[keep], o[keep]
    return v, np.searchsorted(o, np.arange(len(bounds)))
