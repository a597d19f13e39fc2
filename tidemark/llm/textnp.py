"""Word and n-gram hashes over UTF-8 bytes, vectorised; letters A-Z count as a-z."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = pow(0x9E3779B97F4A7C15, 1, 1 << 64) | 1
_BLOCK = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, _U)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * _U(pow(base, done, 1 << 64))
        done += step
    return out


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = down = np.ones(1, _U)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, _BLOCK + 1024)
            cls.up, cls.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h = h * _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_VALUES = mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))[LOWER]

#: Bytes of the words [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, 9, 10, 11, 12, 13]] = False
#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are a-z
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True


def words(data: np.ndarray, bounds: np.ndarray, kind: np.ndarray):
    """(starts, ends, first): byte spans of the words, and each row's first word number (one more entry at the end).

    ``bounds`` are the byte bounds of the rows; no word crosses them.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = kind[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:n]
    closes = inside
    closes[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's lower-cased bytes; temporaries are bounded by blocks."""
    out = np.empty(len(starts), _U)
    if len(starts) == 0:
        return out
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), _BLOCK)), len(starts)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        lo, hi = int(starts[a]), int(ends[b - 1])
        _Powers.reach(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum(_VALUES[data[lo:hi]] * _Powers.up[: hi - lo], out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = (sums[e] - sums[s]) * _Powers.down[s] + (e - s).astype(_U)
    return mixed(out)


def gram_hashes(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hashes of ``k`` consecutive word hashes, in order; ``len(h) - k + 1`` of them, never 0."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.full(n, (salt * 0xD1342543DE82EF95 + k) & ((1 << 64) - 1), _U)
    for j in range(k):
        out = out * _U(0xA0761D6478BD642F) + h[j : j + n]
        out ^= out >> _U(29)
    return mixed(out) | _U(1)


def sliding(f, x: np.ndarray, w: int) -> np.ndarray:
    """``f`` (np.minimum or np.maximum) over every ``w`` neighbours."""
    if len(x) < w:
        return x[:0]
    span = 1
    while 2 * span <= w:
        x = f(x[:-span], x[span:])
        span *= 2
    return f(x[: len(x) - (w - span)], x[w - span :]) if span < w else x


def winnowed(grams: np.ndarray, first: np.ndarray, k: int, w: int) -> np.ndarray:
    """Positions of the grams that are the least of some window of ``w`` grams within one row.

    ``first``: each row's first word number, and the number of words at the end.
    Equal least grams are all kept, so equal windows of two texts keep equal grams.
    """
    n = len(grams)
    if n < w:
        return np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    least = sliding(np.minimum, grams, w)
    m = len(least)
    least = np.where(row[:m] == row[w + k - 2 : w + k - 2 + m], least, _U(0))
    pad = np.zeros(w - 1, _U)
    most = sliding(np.maximum, np.concatenate([pad, least, pad]), w)
    return np.flatnonzero((most == grams) & (most > 0))
