"""Word hashes of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20              # bytes whose words are hashed in one step
_M = np.uint64(0x9E3779B97F4A7C15)
_P = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _M)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        n = max(n, BLOCK + 4096)
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        for k, base in enumerate((_P, inverse)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes other than ASCII blanks)."""
    blank = _BLANK[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(np.r_[True, blank, True]))
    return edges[0::2], edges[1::2]


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: a polynomial in their bytes, by differences of running sums, then mixed."""
    arr, out, at = np.frombuffer(data, np.uint8), np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + BLOCK)))
        lo, hi = int(starts[at]), int(ends[to - 1])
        power, inverse = _powers(hi - lo + 1)
        run = np.r_[np.uint64(0), np.cumsum(_VALUE[arr[lo:hi]] * power[:hi - lo])]
        a, b = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((run[b] - run[a]) * inverse[a] + (b - a).astype(np.uint64) * _M)
        at = to
    return out


def hashed_texts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts behind each other, and where each text's words begin (one entry more)."""
    data = b"\n".join(texts)
    begins = np.cumsum([0, *(len(x) + 1 for x in texts)])
    starts, ends = word_spans(data)
    return word_hashes(data, starts, ends), np.searchsorted(starts, begins)


def slices(texts: list[str | None], size: int = BLOCK):
    """(first, texts as UTF-8) in runs of about ``size`` bytes; null texts are empty."""
    at, part, n = 0, [], 0
    for k, x in enumerate(texts):
        part.append((x or "").encode())
        n += len(part[-1])
        if n >= size:
            yield at, part
            at, part, n = k + 1, [], 0
    if part:
        yield at, part
