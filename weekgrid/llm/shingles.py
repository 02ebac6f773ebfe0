"""Sets of word shingles as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from weekgrid.llm.words import WORD_STEP, Runs, Words

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_sets(texts: list[bytes | None], size: int = 5):
    """(text, hash) of the distinct shingles, sorted by text, then hash; a text
    with fewer words than ``size`` has them all as one shingle, one without words none."""
    words = Words([None if t is None else t.translate(LOWER) for t in texts])
    runs, n = Runs(words.hash, WORD_STEP), len(words.hash)
    i = np.arange(max(0, n - size + 1))
    i = i[words.text_of[i] == words.text_of[i + size - 1]] if n else i
    short = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < size))
    text = np.concatenate([words.text_of[i], short])
    value = np.concatenate([runs.run(i, i + size), runs.run(words.first[short], words.first[short + 1])])
    if len(short):
        order = np.argsort(text, kind="stable")
        text, value = text[order], value[order]
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        value[a:b].sort()
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return text[new], value[new]
