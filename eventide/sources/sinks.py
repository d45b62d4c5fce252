"""Sinks (SNK-1, SNK-3): results are DataFrames; printing is ``show``.
Two reports from one source share one cached read (batch) or one
``foreachBatch`` (streaming, see ``eventide.streaming.io``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def print_rows(df: DataFrame) -> None:
    """SNK-1: print each row, untruncated. Rows come to the driver one
    partition at a time, so the driver holds one partition, not the result."""
    names = df.columns
    for row in df.toLocalIterator():
        print(" ".join(f"{n}={v}" for n, v in zip(names, row)), flush=True)


def fan_out(source: DataFrame, *reports: Callable[[DataFrame], None]) -> None:
    """SNK-3: run several actions over one source, reading it once."""
    cached = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for report in reports:
            report(cached)
    finally:
        cached.unpersist()
