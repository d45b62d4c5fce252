"""Row predicates and indicators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.constants import LATE_AFTER_SECONDS, MIN_CLICK_JUMP


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def indicator(col: Column | str, value: str) -> Column:
    """1 when ``col == value`` else 0 (NULL counts as 0)."""
    return F.coalesce((_c(col) == F.lit(value)).cast("int"), F.lit(0))


def click_jump(current: Column | str, last: Column | str,
               min_diff: int = MIN_CLICK_JUMP) -> Column:
    """Emit when the count is 0 or rose by more than ``min_diff``."""
    cur = _c(current)
    return (cur == 0) | ((cur - _c(last)) > F.lit(min_diff))


def is_late(lateness_us: Column | str, after_seconds: int = LATE_AFTER_SECONDS) -> Column:
    """Strictly more than the deadline is late; exactly the deadline is in time."""
    return _c(lateness_us) > F.lit(after_seconds * 1_000_000)


def null_safe_not(pred: Column) -> Column:
    """Complement that sends NULL to the 'false' side, so that ``pred`` and
    its complement split rows into two disjoint, complete parts."""
    return ~F.coalesce(pred, F.lit(False))
