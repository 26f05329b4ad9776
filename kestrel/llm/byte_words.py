"""Words of many texts at once, with numpy on UTF-8 bytes.

Every class used here separates ASCII bytes only, and all bytes of a non-ASCII character are
at least 0x80, so splitting bytes gives the same words as splitting code points.
"""

from __future__ import annotations

import numpy as np

_BYTES = np.arange(256)

#: bytes that belong to a word: digits, letters, and everything beyond ASCII
WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39) | (_BYTES >= 0x41) & (_BYTES <= 0x5A)
        | (_BYTES >= 0x61) & (_BYTES <= 0x7A) | (_BYTES >= 0x80))
#: bytes that belong to a token: everything but space and U+0009 to U+000D
TOKEN = ~((_BYTES == 0x20) | (_BYTES >= 0x09) & (_BYTES <= 0x0D))
#: A-Z to a-z, other bytes unchanged
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 22:
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: a value per byte, the same for a letter's two cases
_VALUES = mix((LOWER.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))


def word_bounds(flat: np.ndarray, offsets: np.ndarray, members: np.ndarray = WORD):
    """Byte starts and ends of all words, and where each text's words begin (length n + 1)."""
    n = len(flat)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = members[flat]
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word, the same in every text and for either case of A-Z."""
    n = len(flat)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_VALUES[flat] * _powers(_BASE, n), out=total[1:])
    return mix((total[ends] - total[starts]) * _powers(_INVERSE, n + 1)[starts])


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` words from each place on (empty if there are fewer words)."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(words * _powers(_BASE, n), out=total[1:])
    return mix((total[width:] - total[:-width]) * _powers(_INVERSE, n + 1)[:n + 1 - width])


def window_places(word_offsets: np.ndarray, width: int) -> np.ndarray:
    """Boolean per window place of the flat word list: True where a window stays in one text."""
    n = int(word_offsets[-1])
    if n < width:
        return np.zeros(0, bool)
    inside = np.ones(n, bool)
    for back in range(1, width):
        at = word_offsets[1:] - back
        inside[at[at >= word_offsets[:-1]]] = False
    return inside[:n + 1 - width]
