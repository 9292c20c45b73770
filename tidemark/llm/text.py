"""Words and their hashes as numpy arrays, for use inside tasks.

Hashes are polynomials modulo 2**64 over the bytes, then mixed; a prefix sum
gives the hash of any stretch of a text without touching it again.
"""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_SHIFT, _FIRST, _SECOND = np.uint64(33), np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_TIMES = np.uint64(31)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

#: Byte to byte, A-Z lowered and nothing else.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from 0 to n at least."""
    global _powers, _inverses
    if len(_powers) <= n:
        size = 1 << (n + 1).bit_length()
        steps = np.full(size, _BASE, np.uint64)
        steps[0] = 1
        back = np.full(size, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
        back[0] = 1
        _powers, _inverses = np.multiply.accumulate(steps), np.multiply.accumulate(back)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all bits; a bijection of 64-bit numbers."""
    out = x >> _SHIFT
    out ^= x
    out *= _FIRST
    high = out >> _SHIFT
    out ^= high
    out *= _SECOND
    np.right_shift(out, _SHIFT, out=high)
    out ^= high
    return out


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """``out[i]`` covers the first i bytes of ``data``; one longer than it."""
    powers, _ = _grown(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=out[1:])
    return out


def stretch_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the stretches [start, end)."""
    _, inverses = _grown(len(prefix))
    return mix((prefix[end] - prefix[start]) * inverses[start])


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered, in order."""
    data = LOWERED.take(np.frombuffer(text, np.uint8))
    gaps = np.ones(len(data) + 2, bool)
    gaps[1:-1] = _IS_SPACE.take(data)
    edges = np.flatnonzero(gaps[1:] != gaps[:-1])
    return stretch_hashes(prefix_hashes(data), edges[::2], edges[1::2])



def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of all word sequences of ``width``.

    With fewer words the whole sequence is the one element; without words the
    set is empty.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    width_here = min(width, len(words))
    total = np.full(len(words) - width_here + 1, np.uint64(width_here), np.uint64)
    for i in range(width_here):
        # each step mixes, so that order counts and parts do not cancel
        total *= _TIMES
        total += words[i : len(words) - width_here + 1 + i]
        total = mix(total)
    total.sort()
    fresh = np.ones(len(total), bool)
    np.not_equal(total[1:], total[:-1], out=fresh[1:])
    return total[fresh]
