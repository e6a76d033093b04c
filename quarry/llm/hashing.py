"""Vectorised word, line and window hashes over UTF-8 bytes.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, which for UTF-8 text is the
pattern ``[^\\x20\\x09-\\x0D]+``.  All hashes are 64 bit and the same in every process: a
polynomial over the bytes (or over the words of a window) taken from prefix sums, so a
document costs a fixed number of numpy passes whatever the window length.  A polynomial modulo
2**64 is weak on long periodic inputs, so spans of more than ``LONG_SPAN`` bytes are hashed by
BLAKE2 instead.  What is removed or merged is decided by ``digest`` (128 bits) of the content,
where an operator says so.
"""

from __future__ import annotations

import hashlib

import numpy as np

_U = np.uint64
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93


def _lut(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


SPACE = _lut(b" \t\n\v\f\r")
NEWLINE = _lut(b"\n")


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.up = np.ones(1, dtype=_U)
        self.down = np.ones(1, dtype=_U)

    def get(self, n: int):
        if len(self.up) < n:
            size = max(n, 1 << 14)
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, b, dtype=_U)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=_U))
        return self.up[:n], self.down[:n]


_byte_powers = _Powers(_BYTE_BASE)
_word_powers = _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def as_bytes(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text or b"", dtype=np.uint8)


def spans(buf: np.ndarray, separators: np.ndarray = SPACE):
    """Starts and ends of the maximal runs without a separator byte."""
    if not len(buf):
        none = np.zeros(0, dtype=np.int64)
        return none, none
    inside = np.empty(len(buf) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(separators[buf], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


#: Bytes of a span that the polynomial hashes; longer ones go to BLAKE2.
LONG_SPAN = 32


def digest(content: bytes) -> bytes:
    """128-bit digest that stands for the content."""
    return hashlib.blake2b(content, digest_size=16).digest()


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    if not len(starts):
        return np.zeros(0, dtype=_U)
    up, down = _byte_powers.get(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, dtype=_U)
    np.cumsum((buf.astype(_U) + _U(1)) * up[:-1], out=sums[1:])
    out = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))
    for i in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
        span = hashlib.blake2b(buf[starts[i]:ends[i]], digest_size=8).digest()
        out[i] = int.from_bytes(span, "little")
    return out


def word_hashes(text: bytes | None) -> np.ndarray:
    buf = as_bytes(text)
    return span_hashes(buf, *spans(buf))


class Windows:
    """Hashes of arbitrary word ranges of one document."""

    def __init__(self, words: np.ndarray):
        up, self._down = _word_powers.get(len(words) + 1)
        self._sums = np.zeros(len(words) + 1, dtype=_U)
        np.cumsum(words * up[:-1], out=self._sums[1:])
        self.n = len(words)

    def at(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def all(self, k: int) -> np.ndarray:
        """Hash of every window of ``k`` words, by start (none if there are fewer)."""
        m = self.n - k + 1
        if m <= 0:
            return np.zeros(0, dtype=_U)
        return mix((self._sums[k:] - self._sums[:m]) * self._down[:m])


def _sliding(op, x: np.ndarray, w: int) -> np.ndarray:
    """``op`` (minimum or maximum) over every window of ``w``, by doubling."""
    step, rest = 1, w
    while step * 2 <= w:
        x = op(x[:-step], x[step:])
        step *= 2
    rest = w - step
    return op(x[:len(x) - rest], x[rest:]) if rest else x


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions selected by winnowing: every position that holds the minimum of some window
    of ``w`` consecutive hashes (of all of them if there are fewer than ``w``).

    Two sequences that share ``w`` consecutive hashes select the same positions there.  Equal
    minima are all selected, so the choice depends on the window's content alone.
    """
    n = len(hashes)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    w = min(w, n)
    low = _sliding(np.minimum, hashes, w)
    padded = np.concatenate([np.zeros(w - 1, _U), low, np.zeros(w - 1, _U)])
    return np.flatnonzero(_sliding(np.maximum, padded, w) == hashes)


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Mask of ``n`` positions that lie in one of the ranges ``start .. start + length - 1``."""
    marks = np.zeros(n + 1, dtype=np.int64)
    starts = np.asarray(starts, dtype=np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + lengths, n), -1)
    return np.cumsum(marks[:n]) > 0
