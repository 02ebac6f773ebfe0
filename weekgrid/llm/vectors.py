"""Rows with sound vectors, and vectors as numpy matrices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def sound(column: str) -> Column:
    """True where a vector is not null and holds finite numbers only."""
    finite = F.forall(column, lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    return F.col(column).isNotNull() & finite


def matrix(lists, width: int):
    """A column of lists of doubles as rows of ``width``; a shorter one is followed by zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out
