"""Dimension joins with a proven size bound before broadcasting.

A dimension is broadcast only after one bounded pass proves that it has at most ``max_rows``
rows and ``max_bytes`` bytes of values (no more than ``max_rows + 1`` rows are read). Beyond the
bounds the join is left to Catalyst: a shuffle (sort-merge) join on the key, which AQE can
still turn into a broadcast from runtime statistics, or split when a key is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bounds on what may be broadcast: bytes of values, and rows (each costs a hash table entry). A
# stream sends its dimension through the driver again in every micro-batch, so they are small.
DEFAULT_BROADCAST_BYTES = 8 << 20
DEFAULT_BROADCAST_ROWS = 100_000


def fits_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``dim`` provably has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    if dim.isStreaming:
        return False
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 8
                for c in dim.columns), F.lit(0).cast("long"))
    got = dim.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                      F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return got["n"] <= max_rows and got["b"] <= max_bytes


def maybe_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    known_small: bool | None = None) -> DataFrame:
    """Return ``dim`` with a broadcast hint when its size bound holds.

    ``known_small`` lets a caller that already checked (e.g. once per stream) skip the
    count.
    """
    small = fits_broadcast(dim, max_rows) if known_small is None else known_small
    return F.broadcast(dim) if small else dim
