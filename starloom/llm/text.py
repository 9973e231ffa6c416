"""Text measures that several operators of this subpackage share; numpy over UTF-8 bytes.

Words are ``[^\\x20\\x09-\\x0D]+``. They are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np

WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
_IS_WHITE = np.isin(np.arange(256), list(WHITE))
_BASE = 0xD1B54A32D192ED03  # odd, so that its powers have inverses modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the base and its inverse, as many as the longest slice needs."""

    size = 0
    up = down = np.empty(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 1 << 16)
            self.up, self.down = (
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(self.size - 1, b, np.uint64)])
                for b in (_BASE, _INVERSE)
            )
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def word_hashes(raw: bytes) -> np.ndarray:
    """One hash per word: a polynomial in its bytes, from differences of prefix sums."""
    n = len(raw)
    if not n:
        return np.empty(0, np.uint64)
    data = np.frombuffer(raw, np.uint8)
    edge = np.ones(n + 2, bool)
    edge[1:-1] = _IS_WHITE[data]
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    starts, ends = turns[::2], turns[1::2]
    up, down = _powers.upto(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` words in a row."""
    n = len(hashes) - size + 1
    mixed = np.full(max(n, 0), size, np.uint64)
    for i in range(size if n > 0 else 0):
        mixed = mix(mixed * np.uint64(0x9FB21C651E98DF25) + hashes[i : i + n])
    return mixed


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; quicker on short arrays than ``np.unique``."""
    ordered = np.sort(values)
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return ordered[first]


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a text.

    A-Z count as a-z. A text of fewer words has its whole sequence as the only
    shingle, one without words none.
    """
    found = word_hashes(text.encode("utf-8", "replace").lower()) if text else ()
    if not len(found):
        return np.empty(0, np.uint64)
    return distinct(windows(found, min(size, len(found))))


def repeated_words(hashes: np.ndarray) -> int:
    """Words that lie in 3-word windows found twice or more."""
    n = len(hashes)
    if n < 4:
        return 0
    found = windows(hashes, 3)
    order = np.argsort(found)
    ordered = found[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= again
    return int(covered.sum())


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines``.

    ``n_lines`` counts lines with a word; a null or empty text has zeros.
    """
    if not text:
        return 0, 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "replace")
    hashes = word_hashes(raw)
    white = len(raw) - len(raw.translate(None, WHITE))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(hashes),
        len(text) - white,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        len(lines),
    )
