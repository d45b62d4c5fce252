"""Time functions: instants, epoch milliseconds, rebasing, durations, time of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.constants import T0_MS, TIME_OF_DAY


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_ms(col: Column | str) -> Column:
    """Instant to epoch milliseconds (floor), BIGINT."""
    return F.unix_millis(_c(col))


def epoch_us(col: Column | str) -> Column:
    return F.unix_micros(_c(col))


def rebase_ms(offset_ms: Column | str, base_ms: int = T0_MS) -> Column:
    """``base + offset`` milliseconds as an instant (comment time rebasing)."""
    return F.timestamp_millis(F.lit(base_ms) + _c(offset_ms))


def parse_instant(col: Column | str, strict: bool = True) -> Column:
    """ISO-8601 text to instant.

    ``strict`` raises on text that does not parse (like ``Instant.parse``);
    otherwise bad text becomes NULL for a quarantine split.
    """
    text = _c(col)
    parsed = F.try_to_timestamp(text)
    if not strict:
        return parsed
    return F.when(text.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("unparseable instant: "), text))
                  ).otherwise(parsed)


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Exact duration ``end - start`` in microseconds (BIGINT)."""
    return F.unix_micros(_c(end)) - F.unix_micros(_c(start))


def time_of_day(ts: Column | str) -> Column:
    """Label of the UTC hour of ``ts``: Mourning [4,12), Day [12,17),
    Evening [17,24), Midnight [0,4)."""
    hour = F.hour(_c(ts))
    expr = None
    for label, lo, hi in TIME_OF_DAY:
        cond = (hour >= lo) & (hour < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr
