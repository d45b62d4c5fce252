"""Inline rows (SRC-1, SRC-2): a literal list becomes a DataFrame with an
explicit ``ord`` column, because arrival order is data, not an accident of
partitioning."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str,
              with_ord: bool = True) -> DataFrame:
    """Rows in the given order; ``ord`` (0-based) is prepended when asked."""
    rows = list(rows)
    if with_ord:
        return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"ord INT, {schema}")
    return spark.createDataFrame(rows, schema)
