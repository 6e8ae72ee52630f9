"""Share one computed frame between several outputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def kept(
    df: DataFrame, outputs: int = 2, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep ``df`` while the block runs, then let it go. With one output there is nothing to
    share, so it is not stored. Lost blocks are computed again from their lineage."""
    if outputs < 2:
        yield df
        return
    stored = df.persist(level)
    try:
        stored.count()
        yield stored
    finally:
        stored.unpersist()
