"""Fixed-width bins over edges ``0, w, 2w, …`` as closed-form expressions.

The quotient ``x / w`` may be off by one step when ``w`` has no exact binary
form; each function therefore compares ``x`` with the neighbouring edges, so the
result is the one a search over the real edges gives.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def edge_count(upper: float, width: float) -> int:
    """Number of edges ``0, w, 2w, …`` below ``upper``."""
    return max(0, math.ceil(upper / width))


def edge(index: Column, width: float) -> Column:
    return index * F.lit(float(width))


def nearest_edge(x: Column, width: float, edges: int) -> Column:
    """Index of the closest edge, the lower one on a tie, clamped to the edges.

    NULL for a missing value (NULL or NaN).
    """
    w = float(width)
    inside = F.least(F.greatest(x, F.lit(0.0)), F.lit((edges - 1) * w))
    guess = F.ceil(inside / w - 0.5)
    off = F.abs(edge(guess, w) - inside)
    step = (
        F.when(F.abs(edge(guess - 1, w) - inside) <= off, -1)
        .when(F.abs(edge(guess + 1, w) - inside) < off, 1)
        .otherwise(0)
    )
    nearest = F.least(F.greatest(guess + step, F.lit(0)), F.lit(edges - 1)).cast("bigint")
    return F.when(x.isNotNull() & ~F.isnan(x.cast("double")), nearest)


def interval(x: Column, width: float, edges: int) -> Column:
    """Index of the half-open interval holding ``x``; the last one is closed.

    NULL outside of the edges.
    """
    w = float(width)
    last = (edges - 1) * w
    guess = F.floor(x / w)
    step = F.when(edge(guess + 1, w) <= x, 1).when(edge(guess, w) > x, -1).otherwise(0)
    index = F.least(guess + step, F.lit(edges - 2))
    return F.when((x >= 0) & (x <= last), index).cast("bigint")
