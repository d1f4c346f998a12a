"""Word shingles as sorted arrays of 64-bit hashes, computed with array operations."""

from __future__ import annotations

import numpy as np

WIDTH = 5  # words of a shingle
SIGNATURE_BITS = 1024

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _lower(code: int) -> int:
    return code + 32 if 65 <= code <= 90 else code


_BYTES = mixed(np.array([_lower(c) + 1 for c in range(256)], dtype=_U) * _BASE)  # a value for each byte, A-Z as a-z
_BLANK = np.array([c == 32 or 9 <= c <= 13 for c in range(256)])
_PLACES = mixed(np.arange(1, WIDTH + 1, dtype=_U) * _U(0xD1B54A32D192ED03)) | _U(1)
_INVERSE = _U(pow(int(_BASE), -1, 2**64))
_powers: list[np.ndarray] = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 65_536)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, in order; words are runs of characters other than white space, A-Z in lower case."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=_U)
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[data], [True]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, dtype=_U)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=_U)
    np.cumsum(_BYTES[data] * up[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _BASE)


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingles of a text, sorted. Fewer words than ``WIDTH`` make one shingle, no words make none."""
    words = word_hashes(text or "")
    n = len(words)
    if n == 0:
        return words
    if n < WIDTH:
        return mixed(np.array([(words * _PLACES[:n]).sum(dtype=_U) + _U(n)], dtype=_U))
    last = n - WIDTH + 1
    total = words[:last] * _PLACES[0]
    for k in range(1, WIDTH):
        total = total + words[k : k + last] * _PLACES[k]
    return np.unique(mixed(total))


def signature(found: np.ndarray) -> bytes:
    """A bitmap with the bit of each shingle set."""
    bits = np.zeros(SIGNATURE_BITS, dtype=np.uint8)
    bits[(found & _U(SIGNATURE_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def overlap_bound(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The most shingles two sets can share. A bit set in one bitmap only stands for a shingle that the other set lacks."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def bitmaps(signatures) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), dtype=np.uint64).reshape(-1, SIGNATURE_BITS // 64)
