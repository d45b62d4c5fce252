"""Keyed state machines for Structured Streaming (``transformWithStateInPandas``),
used only where no built-in stateful operator fits (S-8, S-11, S-12).

Rows of one key inside one micro-batch arrive in no guaranteed order, so
each handler sorts them by the event order first. Across micro-batches the machines
take rows in arrival order (the reference's semantics). For event order they are chained to
``jobs.in_event_order``, which holds rows back in windows until the watermark has passed
them (S-13); so no machine keeps rows. State lives in the state store (RocksDB): a
handler reads a value once, folds its rows and writes it back once, and of a map it reads
and writes only the entries that its rows touch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from eventide import constants as K


def _label(epoch_ms: int) -> str:
    hour = (epoch_ms // 3_600_000) % 24
    for label, lo, hi in K.TIME_OF_DAY:
        if lo <= hour < hi:
            return label
    raise ValueError(hour)


def _read_map(state) -> dict:
    return {k[0]: v[0] for k, v in state.iterator()} if state.exists() else {}


def _add_to_map(state, counts: dict) -> None:
    """Add ``counts`` to a map state, entry by entry; other entries are not read."""
    for k, n in counts.items():
        old = state.getValue((k,)) if state.containsKey((k,)) else None
        state.updateValue((k,), ((old[0] if old else 0) + n,))


def _order(entry):
    """Count descending, then name ascending with NULL first."""
    name, n = entry
    return -n, name is not None, name or ""


def _top(counts: dict, n: int) -> list[tuple[str, int]]:
    return sorted(counts.items(), key=_order)[:n]


def _frame(rows, order: Sequence[str]):
    """All pandas batches of one key in one micro-batch, sorted by order."""
    import pandas as pd
    frames = [f for f in rows if len(f)]
    if not frames:
        return None
    pdf = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    return pdf.sort_values(list(order), kind="stable").reset_index(drop=True)


class OrderedProcessor(StatefulProcessor):
    """Feeds ``fold(key, frame)`` with the rows of a key in a micro-batch, in ``order``."""

    order: list

    def fold(self, key, pdf):
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues):
        pdf = _frame(rows, self.order)
        if pdf is not None:
            yield self.fold(key, pdf)

    def close(self) -> None:
        pass


class PreviousValueProcessor(OrderedProcessor):
    """W-1 + P-10 (``transformWithStateInPandas``): emit rows whose value is
    0 or rose by more than ``min_diff`` since the key's previous row (0 before the
    first; nothing rises from or to a NULL); the previous value moves on every
    row. With ``ttl_ms`` a key's value goes that long (processing time) after its last
    row, and the key starts anew.

    Rows come grouped by a part of the keys, not by key: a call costs milliseconds, so keys of few rows
    share one. The state is a map from key to last value; the entries of the keys seen are read and
    written once a micro-batch. Vectorized: one sort, one shift, one mask over all keys of a part.
    Output: key column, ``keep`` columns, value, last."""

    def __init__(self, key: str, key_type: str, order: Sequence[str], value: str, keep: Sequence[str],
                 min_diff: int = K.MIN_CLICK_JUMP, last_name: str = "last_value", ttl_ms: int | None = None):
        self.key, self.key_type, self.order, self.value = key, key_type, list(order), value
        self.keep, self.min_diff, self.last_name, self.ttl_ms = list(keep), min_diff, last_name, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", f"key {self.key_type}", "last LONG", self.ttl_ms)

    def fold(self, part, pdf):
        import numpy as np
        import pandas as pd
        codes, _ = pd.factorize(pdf[self.key], use_na_sentinel=False)
        by_key = np.argsort(codes, kind="stable")       # the frame is in event order
        pdf, codes = pdf.iloc[by_key].reset_index(drop=True), codes[by_key]
        ends = np.flatnonzero(np.append(codes[1:] != codes[:-1], True))
        starts = np.append(0, ends[:-1] + 1)
        vals = pdf[self.value].astype("Int64")
        keys = [None if pd.isna(k) else k for k in pdf[self.key].iloc[starts].tolist()]
        before = [self.last.getValue((k,)) for k in keys]
        lasts = vals.shift()
        lasts.iloc[starts] = pd.array([0 if old is None else old[0] for old in before], "Int64")
        mask = ((vals == 0) | (vals - lasts > self.min_diff)).fillna(False).to_numpy(bool)
        for k, end in zip(keys, vals.iloc[ends]):
            self.last.updateValue((k,), (None if pd.isna(end) else int(end),))
        out = pdf.loc[mask, [self.key, *self.keep]].copy()
        out[self.value] = vals[mask].to_numpy()
        out[self.last_name] = lasts[mask].to_numpy()
        return out.reset_index(drop=True)


class ThresholdBatchProcessor(OrderedProcessor):
    """W-2 + AGG-13 + K-1 (``transformWithStateInPandas``): per key, close a
    batch on the row that brings its installs to ``install_threshold`` or
    uninstalls to ``uninstall_threshold``; emit the top apps of each side,
    then reset. The counts are cumulative sums and each
    closing row is found by ``searchsorted`` (work per *batch*, not per
    row); per-app counts of a batch are one ``value_counts`` of its slice. The
    maps hold the open batch: they are read whole only when it closes, before that only
    the apps of the new rows are touched.
    Output: key, batch_no, kind, rank, app, n."""

    def __init__(self, key: str, order: Sequence[str], kind: str, app: str,
                 install_threshold: int = K.INSTALL_THRESHOLD,
                 uninstall_threshold: int = K.UNINSTALL_THRESHOLD, top_n: int = K.TOP_APPS,
                 install_value: str = K.EVENT_INSTALL, uninstall_value: str = K.EVENT_UNINSTALL):
        self.key, self.order, self.kind, self.app = key, list(order), kind, app
        self.ti, self.tu, self.top_n = install_threshold, uninstall_threshold, top_n
        self.iv, self.uv = install_value, uninstall_value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counters = handle.getValueState("counters", "installs LONG, uninstalls LONG, batch_no LONG")
        self.installs = handle.getMapState("installs", "app STRING", "n LONG")
        self.uninstalls = handle.getMapState("uninstalls", "app STRING", "n LONG")

    @staticmethod
    def _counts(apps) -> dict:
        return {a: int(n) for a, n in apps.value_counts().items()}

    def fold(self, key, pdf):
        import numpy as np
        import pandas as pd
        ci0, cu0, batch = self.counters.get() if self.counters.exists() else (0, 0, 1)
        is_i = (pdf[self.kind] == self.iv).to_numpy()
        is_u = (pdf[self.kind] == self.uv).to_numpy()
        ci, cu = np.cumsum(is_i), np.cumsum(is_u)
        apps = pdf[self.app]
        base_i, base_u, start, n = -int(ci0), -int(cu0), 0, len(pdf)
        out = []
        while True:
            end = min(int(np.searchsorted(ci, base_i + self.ti, "left")),
                      int(np.searchsorted(cu, base_u + self.tu, "left")))
            if end >= n:
                break
            sl = slice(start, end + 1)
            for kind, side, state in (("install", is_i, self.installs), ("uninstall", is_u, self.uninstalls)):
                counts = self._counts(apps[sl][side[sl]])
                if start == 0:      # the batch that was open before these rows
                    for a, c in _read_map(state).items():
                        counts[a] = counts.get(a, 0) + c
                    state.clear()
                for rank, (a, c) in enumerate(_top(counts, self.top_n), start=1):
                    out.append((key[0], batch, kind, rank, a, c))
            base_i, base_u, start, batch = int(ci[end]), int(cu[end]), end + 1, batch + 1
        sl = slice(start, n)
        _add_to_map(self.installs, self._counts(apps[sl][is_i[sl]]))
        _add_to_map(self.uninstalls, self._counts(apps[sl][is_u[sl]]))
        self.counters.update((int(ci[-1]) - base_i, int(cu[-1]) - base_u, batch))
        return pd.DataFrame(out, columns=[self.key, "batch_no", "kind", "rank", "app", "n"])


class PeriodChangeProcessor(StatefulProcessor):
    """W-3 .. W-5 + AGG-12 + K-2 (``transformWithStateInPandas``) over closed tumbling windows.
    Input rows are (topic, window_start_ms, acronym, n, min_time_ms) from a windowed
    aggregate; on a label change the finished period's top acronyms are
    emitted with the new period's label and first time. The map holds the open
    period's counts; it is read whole only when the period ends."""

    def __init__(self, key: str = "topic", top_n: int = K.TOP_ACRONYMS):
        self.key, self.top_n = key, top_n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.period = handle.getValueState("period", "label STRING, total LONG")
        self.counts = handle.getMapState("acronyms", "acronym STRING", "n LONG")

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd
        pdf = _frame(rows, ["window_start_ms"])
        if pdf is None:
            return
        windows = pdf.groupby("window_start_ms", sort=True)["min_time_ms"].min()
        labels = pd.Series([_label(int(t)) for t in windows], index=windows.index)
        run = (labels != labels.shift()).cumsum()
        label, total = self.period.get() if self.period.exists() else (None, 0)
        out = []
        by_run = pdf.assign(_run=pdf["window_start_ms"].map(run)).groupby("_run", sort=True)
        for nr, part in by_run:
            first_window = windows.index[(run == nr).argmax()]
            now, first = labels[first_window], int(windows[first_window])
            counts = {None if pd.isna(a) else a: int(n) for a, n in part.groupby("acronym", dropna=False)["n"].sum().items()}
            if label is not None and now != label:
                for a, n in _top(_read_map(self.counts), self.top_n):
                    out.append((key[0], a, n, total, now, first, label))
                self.counts.clear()
                total = 0
            label, total = now, total + sum(counts.values())
            _add_to_map(self.counts, counts)
        self.period.update((label, total))
        yield pd.DataFrame(out, columns=[self.key, "acronym", "acronyms_counter", "total_comments_counter",
                                         "label_time_of_day", "closed_at_ms", "period_time_of_day"])

    def close(self) -> None:
        pass


class SessionMergeProcessor(StatefulProcessor):
    """S-6 over closed buckets as wide as the gap (``transformWithStateInPandas``): rows are
    (key, bucket start, first and last time in us, count), in order over the micro-batches. Rows of one
    bucket are in one session; a bucket goes on with the session if its first row is at most the gap after the session's last
    one. The session comes out when the next one begins, or when the watermark has passed the bucket in which a
    row could still go on with it. State: one open session per key. Output: key, start_us, last_us, n."""

    def __init__(self, key: str, gap_us: int):
        self.key, self.gap_us = key, gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "lo LONG, hi LONG, n LONG, timer LONG")

    def _timer(self, hi: int) -> int:
        """End of the bucket that holds ``hi + gap``, in ms."""
        return -(-((hi + self.gap_us) // self.gap_us + 1) * self.gap_us // 1000)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd
        pdf = _frame(rows, ["lo"])
        if pdf is None:
            return
        lo, hi, n = pdf["lo"], pdf["hi"], pdf["n"]
        timer = None
        if self.open.exists():
            start, last, held, timer = self.open.get()
            lo, hi, n = (pd.concat([pd.Series([v]), c], ignore_index=True) for v, c in ((start, lo), (last, hi), (held, n)))
        new = (lo - hi.shift()) > self.gap_us
        parts = pd.DataFrame({"lo": lo, "hi": hi, "n": n}).groupby(new.cumsum()).agg({"lo": "min", "hi": "max", "n": "sum"})
        start, last, held = (int(v) for v in parts.iloc[-1])
        due = self._timer(last)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.open.update((start, last, held, due))
        yield self._frame(key, parts.iloc[:-1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd
        if self.open.exists():
            lo, hi, n, _ = self.open.get()
            self.open.clear()
            yield self._frame(key, pd.DataFrame({"lo": [lo], "hi": [hi], "n": [n]}))

    def _frame(self, key, parts):
        import pandas as pd
        return pd.DataFrame({self.key: [key[0]] * len(parts), "start_us": parts["lo"].to_numpy(),
                             "last_us": parts["hi"].to_numpy(), "n": parts["n"].to_numpy()})

    def close(self) -> None:
        pass


class QuietReportProcessor(StatefulProcessor):
    """S-8 (``transformWithStateInPandas``): count rows per status and emit
    the counts once no input has arrived for ``gap_ms`` of processing time (a
    processing-time session per key). Output: key, status, n."""

    def __init__(self, key: str, status: str, gap_ms: int = K.QUIET_GAP_SECONDS * 1000):
        self.key, self.status, self.gap_ms = key, status, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "status STRING", "n LONG")
        self.deadline = handle.getValueState("deadline", "ms LONG")

    def handleInputRows(self, key, rows, timerValues):
        for pdf in rows:
            for status, n in pdf[self.status].value_counts().items():
                old = self.counts.getValue((status,))[0] if self.counts.containsKey((status,)) else 0
                self.counts.updateValue((status,), (old + int(n),))
        if self.deadline.exists():
            self.handle.deleteTimer(self.deadline.get()[0])
        due = timerValues.getCurrentProcessingTimeInMs() + self.gap_ms
        self.handle.registerTimer(due)
        self.deadline.update((due,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pandas as pd
        counts = sorted(_read_map(self.counts).items())
        self.counts.clear()
        self.deadline.clear()
        yield pd.DataFrame({self.key: [key[0]] * len(counts), "status": [s for s, _ in counts],
                            "n": [n for _, n in counts]})

    def close(self) -> None:
        pass
