"""Vectors as rows: which take part, and numpy views of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F


def usable(column: str = "embedding") -> F.Column:
    """Not null, without null or non-finite components, and not zero."""
    c = F.col(column)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(c.isNotNull() & fine & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """An Arrow list column of equally long vectors as a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def unit(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, by their largest component first so that no square overflows or vanishes."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))
