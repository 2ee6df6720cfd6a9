"""Words of many texts at once: spans and hashes by array arithmetic on UTF-8 bytes."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# After lower-casing, every byte but these parts words: digits, a-z, and all of non-ASCII text.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

# Every byte but ASCII white space.
SOLID = np.ones(256, bool)
SOLID[9:14] = SOLID[32] = False

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def _power(kind: str, factor: int, n: int) -> np.ndarray:
    if len(_powers[kind]) <= n:
        full = np.full(max(n + 1, 1 << 20), factor, U)
        full[0] = 1
        _powers[kind] = np.cumprod(full, dtype=U)
    return _powers[kind]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the n + 1 offsets of each text's words among them.

    ``inside`` tells for each byte value whether it belongs to a word; a text's end ends one.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    flag = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = flag[:-1]
    starts = np.flatnonzero(flag & (~before | first[:-1]))
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = flag[1:]
    ends = np.flatnonzero(flag & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever the span stands."""
    if not len(starts):
        return np.zeros(0, U)
    n = len(data)
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum((data.astype(U) + U(1)) * _power("up", BASE, n)[:n], out=sums[1:])
    found = (sums[ends] - sums[starts]) * _power("down", BASE_INVERSE, n)[starts]
    return mix(found + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def joined(*parts: np.ndarray) -> np.ndarray:
    """One hash of hashes in order."""
    total = parts[0]
    for part in parts[1:]:
        total = mix(total * U(BASE) + part)
    return total
