"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension side is broadcast only when it has at most this many rows.
DEFAULT_BROADCAST_ROWS = 1_000_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if ``df`` has at most ``max_rows`` rows, else ``df``.

    The check runs ``limit(max_rows + 1).count()`` on the dimension side only
    (each partition reads at most ``max_rows + 1`` rows).  Above the bound
    the join is left to the planner (sort-merge with AQE skew splitting, or
    a runtime broadcast when the materialised size turns out small).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
