"""Size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skulink.session import materialize

MAX_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """Broadcast ``df`` only when a count proves it small.

    Returns the (possibly hinted) frame and its row count.  Beyond the
    limit the frame is returned as is and the join stays a shuffle join
    (AQE may still pick broadcast from runtime statistics).
    """
    # the list is an aggregate over all postings: checkpoint it so the count
    # and the join read the result instead of aggregating twice
    df = materialize(df)
    n = df.count()
    return (F.broadcast(df) if n <= max_rows else df), n


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join whose sides may be far larger than the files they come from.

    Spark plans broadcasts from file sizes; exploded rows and word lists unpack to many times
    that, and a broadcast passes through the driver.  The hint keeps the join a shuffled one.
    """
    return df.hint("merge")
