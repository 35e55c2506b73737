"""Size checks in front of broadcasts.

A side is broadcast only when its row count is proven below a bound; beyond
it the join is a shuffle join by hint: Spark's own estimate goes by the size of
compressed files, which hold the ids of staged rows and not the hashes made of
them, and would broadcast millions of keys. Parameter grids (months, days) are bounded by
their parameters, not by data, and are broadcast directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A row of a hashed relation of 32-character keys takes about 100 bytes, so a
# side is at most 50 MB, and a hub's union of four sources at most 200 MB.
DEFAULT_MAX_BROADCAST_ROWS = 500_000


def row_count_at_most(df: DataFrame, bound: int) -> bool:
    """A partial count per task (no rows are moved), kept with the frame for the next question."""
    if not hasattr(df, "_hvault_rows"):
        df._hvault_rows = df.count()
    return df._hvault_rows <= bound


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as the side of a join that is never broadcast, whatever Spark takes its size for."""
    return df.hint("merge")


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """``df`` with a broadcast hint when it (or ``counted``, a frame of as many rows) is small, else kept from being broadcast."""
    return F.broadcast(df) if row_count_at_most(df if counted is None else counted, max_rows) else shuffled(df)
