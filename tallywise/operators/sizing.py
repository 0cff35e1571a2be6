"""Size-checked broadcast.

A broadcast hint is only placed when the optimizer's own size estimate for
the side is below a bound; otherwise the join is left to the planner (and to
AQE, which converts to a broadcast at runtime from real shuffle sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer estimate of the size of ``df`` (no job is run)."""
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - connect sessions have no _jdf
        return 1 << 62


# File-based estimates are compressed sizes; rows in memory are larger. The
# estimate is scaled by this factor before it is compared with the bound.
IN_MEMORY_FACTOR = 4


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its estimated in-memory size is under
    ``max_bytes``; otherwise the plain frame (a shuffle join, which AQE may
    still turn into a broadcast from the real runtime size)."""
    return F.broadcast(df) if estimated_bytes(df) * IN_MEMORY_FACTOR <= max_bytes else df


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join, whatever the optimizer's estimate of its size.

    The estimate scales a file's compressed size by the width of the columns read and knows
    neither of texts built from keys nor of exploded rows, so the planner would broadcast a side that
    grows with the tables; as a hash table it takes some 500 bytes a row in the driver and each task."""
    return df.hint("merge")
