"""Hashes of all words of a text at once."""

from __future__ import annotations

import numpy as np

#: A-Z become small, and the blanks between words (space, tab to carriage return) one byte.
_LOW = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
SEGMENT = 1 << 18
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, kept by the worker."""
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 1 << 17)
        inverse = pow(_BASE, -1, 1 << 64)
        _powers = tuple(
            np.concatenate(([np.uint64(1)], np.cumprod(np.full(n, base, np.uint64)))) for base in (_BASE, inverse)
        )
    return _powers


def hashed_words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (A-Z as small letters), and where it starts and ends."""
    (hashes,), starts, ends = hashed_prefixes(text, ())
    return hashes, starts, ends


def hashed_prefixes(text: bytes, sizes: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Hashes of whole words and of their first so many bytes (0 for words that are not longer).

    A long text is taken in segments that end at blanks, so that the working arrays stay small.
    """
    low, parts, at = text.translate(_LOW), [], 0
    while at < len(low):
        end = len(low)
        if end - at > SEGMENT:
            end = low.rfind(b" ", at, at + SEGMENT) + 1 or low.find(b" ", at + SEGMENT) + 1 or len(low)
        parts.append((at, _hashed_segment(low[at:end], sizes)))
        at = end
    if not parts:
        parts = [(0, _hashed_segment(b"", sizes))]
    if len(parts) == 1:
        return parts[0][1]
    hashes = [np.concatenate(each) for each in zip(*(p[0] for _, p in parts), strict=True)]
    return hashes, *(np.concatenate([p[side] + at for at, p in parts]) for side in (1, 2))


def _hashed_segment(low: bytes, sizes: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """One running polynomial is summed up; a hash is the difference of two sums, moved to the start by the inverse power."""
    chars = np.frombuffer(low, np.uint8)
    inside = np.zeros(len(chars) + 2, bool)
    inside[1:-1] = chars != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _power_tables(len(chars))
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * power[:len(chars)], out=sums[1:])
    whole = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    found = [whole]
    for size in sizes:
        long = ends - starts > size
        first = np.where(long, starts, 0)
        part = mixed((sums[np.minimum(first + size, len(chars))] - sums[first]) * inverse[first] + np.uint64(size + (1 << 32)))
        found.append(np.where(long, part, np.uint64(0)))
    return found, starts, ends


#: A-Z become small; ASCII that is no letter becomes a blank; bytes beyond ASCII stay.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def small_letters(text: bytes) -> bytes:
    """Words of small letters between blanks; of capitals beyond ASCII, those of Latin-1 become small."""
    plain = text.translate(LETTERS)
    if plain.isascii():
        return plain
    chars = np.frombuffer(plain, np.uint8).copy()
    capital = np.flatnonzero(chars[:-1] == 0xC3) + 1
    here = chars[capital]
    chars[capital] = np.where((here >= 0x80) & (here <= 0x9E) & (here != 0x97), here + 0x20, here)
    return chars.tobytes()
