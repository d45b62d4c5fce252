"""Report lines (the reference prints text; we keep the fields as columns and
render a line only at the report edge). No wall-clock prefix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.constants import NO_BOOKINGS_TEXT


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def window_count_line(start_ms, end_ms, n) -> Column:
    return F.format_string("Window [%d - %d] click count: %d", _c(start_ms), _c(end_ms), _c(n))


def or_missing(value, text: str = NO_BOOKINGS_TEXT) -> Column:
    return F.coalesce(_c(value).cast("string"), F.lit(text))


def min_max_line(key, start_ms, end_ms, lo, hi) -> Column:
    return F.format_string(
        "Window [%d - %d] Type %s bookings count: Min=%s Max=%s.",
        _c(start_ms), _c(end_ms), _c(key), or_missing(lo), or_missing(hi))


def store_count_item(store, n) -> Column:
    return F.format_string("Store: %s Error count: %d", _c(store), _c(n))


def ranked_list(items: Column) -> Column:
    """``array<struct<name, n>>`` (already ordered) to ``name (n), ...``."""
    return F.array_join(
        F.transform(items, lambda x: F.format_string("%s (%d)", x["name"], x["n"])), ", ")


def top_apps_line(store, installs: Column, uninstalls: Column) -> Column:
    return F.format_string(
        "INSTALL/UNINSTALL Store: %s Top %d installed: %s Top %d uninstalled: %s ",
        _c(store), F.size(installs), ranked_list(installs),
        F.size(uninstalls), ranked_list(uninstalls))
