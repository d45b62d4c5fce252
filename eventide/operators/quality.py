"""Stream splitting and input validation (P-6, P-8, VAL-2, VAL-3, VAL-4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.predicates import null_safe_not


def split(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """P-6: ``(rest, side)``: rows where ``pred`` is true go to the side
    output, all others (NULL included) stay on the main output."""
    return df.filter(null_safe_not(pred)), df.filter(pred)


def require(df: DataFrame, ok: Column, message: Column) -> DataFrame:
    """``df``, failing the job on a row where ``ok`` is not true. The check is a
    row filter, so no column pruning and no ``count()`` skips it."""
    return df.filter(F.assert_true(F.coalesce(ok, F.lit(False)), message).isNull())


def check_domain(df: DataFrame, col: str, domain: Sequence[str]) -> DataFrame:
    """P-8 / VAL-3 strict: fail the job on a value outside ``domain``."""
    return require(df, F.col(col).isin(*domain),
                   F.concat(F.lit(f"invalid {col}: "), F.coalesce(F.col(col).cast("string"), F.lit("NULL"))))


def quarantine_domain(df: DataFrame, col: str, domain: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """P-8 / VAL-3 quarantine: ``(good, bad)`` split on the domain."""
    return split(df, ~F.coalesce(F.col(col).isin(*domain), F.lit(False)))


def check_weights(weights: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """VAL-4: per dimension, whether the probabilities reach 1 (so every
    draw p in [0, 1] finds an item)."""
    return weights.groupBy("dimension").agg(
        F.sum("probability").alias("total"),
        (F.abs(F.sum("probability") - F.lit(1.0)) <= F.lit(tolerance)).alias("valid"))


def tee(df: DataFrame, pred: Column) -> tuple[DataFrame, DataFrame]:
    """P-7: ``(all rows, copy of the rows where pred holds)``; unlike
    ``split`` the matching rows also stay on the main output."""
    return df, df.filter(F.coalesce(pred, F.lit(False)))
