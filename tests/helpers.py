"""Values and small functions that several test modules use."""

T0_MS = 1689379200000


def at(ms: int):
    """Instant t0 + ms as a Python datetime (UTC)."""
    import datetime as dt
    return dt.datetime.fromtimestamp((T0_MS + ms) / 1000, tz=dt.timezone.utc)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
