"""Hashes of words and word runs, computed for many documents at once.

A word is a run of bytes other than space and the control characters 9 to 13,
as in UTF-8 these bytes are never part of another character. All sums wrap
modulo 2**64; the multipliers are odd, so they have inverses there.
"""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
BYTE_STEP, WORD_STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mix(x):
    """Spreads every input bit over all 64 (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(step: int, n: int):
    """step**0 .. step**n."""
    out = np.full(n + 1, step & MASK, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Runs:
    """Hashes of runs of values from prefix sums: run(i, j) covers values[i:j]."""

    def __init__(self, values, step: int):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(step, n)[:n], dtype=np.uint64, out=self.sums[1:])
        self.back = powers(pow(step, -1, 1 << 64), n)

    def run(self, i, j):
        return mix((self.sums[j] - self.sums[i]) * self.back[i] + (j - i).astype(np.uint64))


class Words:
    """The words of a list of texts (bytes or None), with ``first[t]`` the number
    of the first word of text t, and one more entry for the end."""

    def __init__(self, texts):
        data = b"\n".join(t or b"" for t in texts) + b"\n"
        self.data = data
        raw = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(raw) + 1, bool)
        inside[1:] = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = turns[::2], turns[1::2]
        sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        self.first = np.searchsorted(self.start, self.offset)
        table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(WORD_STEP))
        self.hash = Runs(table[raw], BYTE_STEP).run(self.start, self.end)
        self.text_of = np.repeat(np.arange(len(texts)), np.diff(self.first))
