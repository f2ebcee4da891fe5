"""Join sides whose size is known before a query runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of files (of the columns that are read) up to which a join side is sent to all executors.
SMALL = 8 << 20


def small(df: DataFrame, most: int = SMALL) -> bool:
    """Whether the planner's size of ``df`` (of files: their bytes, no job) is at most ``most``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def sized(df: DataFrame) -> DataFrame:
    """A join side, broadcast where it is small; a larger one is left to the planner.

    A session may hold its own limit far below what an executor can keep, and each
    join then shuffles all rows of the other side, which is what fills the disks."""
    return F.broadcast(df) if small(df, SMALL) else df
