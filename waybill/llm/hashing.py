"""Numpy marks of words and word windows, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_word = xxhash.xxh3_64_intdigest


def word_marks(text: str | None, lower: bool = False) -> tuple[list[bytes], np.ndarray]:
    """The words of a text as UTF-8, and a 64-bit mark of each.

    ``bytes.split()`` splits at exactly 0x20 and 0x09 to 0x0D; ``bytes.lower()`` lowers only A to Z.
    """
    raw = text.encode() if text else b""
    found = (raw.lower() if lower else raw).split()
    return found, np.fromiter(map(_word, found), dtype=np.uint64, count=len(found))


_PLAIN = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def plain_marks(text: str | None) -> np.ndarray:
    """Marks of the words of a text in lower case, ASCII punctuation counting as blanks."""
    found = text.lower().encode().translate(_PLAIN).split() if text else []
    return np.fromiter(map(_word, found), dtype=np.uint64, count=len(found))


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Rabin-Karp hashes modulo 2**64 of all windows of ``width`` marks."""

    def __init__(self, base: int, width: int):
        self.base, self.width = base | 1, width
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        n = 1 << n.bit_length()
        inverse = pow(self.base, -1, 1 << 64)

        def grow(factor: int) -> np.ndarray:
            powers = np.full(n, factor, dtype=np.uint64)
            powers[0] = 1
            return np.cumprod(powers, dtype=np.uint64)

        self.up, self.down = grow(self.base), grow(inverse)

    def __call__(self, marks: np.ndarray) -> np.ndarray:
        n = len(marks) - self.width + 1
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        if len(self.up) < len(marks):
            self._powers(len(marks))
        sums = np.zeros(len(marks) + 1, dtype=np.uint64)
        np.cumsum(marks * self.up[: len(marks)], out=sums[1:])
        return (sums[self.width:] - sums[:-self.width]) * self.down[:n]
