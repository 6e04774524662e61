"""Word positions and hashes of UTF-8 text, by numpy over whole buffers."""

from __future__ import annotations

import numpy as np
import xxhash

_U = np.uint64
# Odd multipliers (fixed, so that all tasks agree).
_STEP = _U(0x9E3779B97F4A7C15)
_LONG = 64  # words of more bytes are hashed by xxhash

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_POW = _powers(_STEP, _LONG)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (all bits depend on all bits)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte start and end of each word of a buffer."""
    space = _SPACE[buf]
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    return edge[0::2], edge[1::2]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes."""
    if not len(starts):
        return np.empty(0, dtype=_U)
    lens = ends - starts
    body = buf[~_SPACE[buf]].astype(_U)
    first = np.cumsum(lens) - lens
    at = np.arange(len(body)) - np.repeat(first, lens)
    with np.errstate(over="ignore"):
        np.minimum(at, _LONG - 1, out=at)
        body += _U(1)
        body *= _POW[at]
        h = np.add.reduceat(body, first) + lens.astype(_U) * _STEP
    for i in np.flatnonzero(lens > _LONG):
        h[i] = xxhash.xxh64_intdigest(buf[starts[i]:ends[i]].tobytes())
    return mix(h)


def rolling(h: np.ndarray, n: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (len(h) - n + 1 of them)."""
    count = len(h) - n + 1
    if count <= 0:
        return np.empty(0, dtype=_U)
    out = None
    with np.errstate(over="ignore"):
        done, size, part, factor = 0, 1, h, _U(base)
        rest = n
        while rest:
            if rest & 1:
                piece = part[done:done + count]
                out = piece.copy() if out is None else out * factor + piece
                done += size
            rest >>= 1
            if rest:
                part = part[:-size] * factor + part[size:]
                size, factor = size * 2, factor * factor
        return mix(out)


def sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each run of ``n`` consecutive values."""
    size, out = 1, a
    while size * 2 <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < n:
        out = np.minimum(out[:len(a) - n + 1], out[n - size:n - size + len(a) - n + 1])
    return out
