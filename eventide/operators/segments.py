"""Count-driven batches per key (W-2, S-9, AGG-13, K-1).

Per key, rows in ``order`` form batches; a batch closes on the row that
brings its installs to ``install_threshold`` or its uninstalls to
``uninstall_threshold``; both counters then restart. Other rows (page views)
belong to the batch but count for neither side. Rows after the last closing
row form the open batch, which is not reported (``keep_open`` keeps it).

One plan for keys of any size; the rows are shuffled once:

1. They are dealt into even ranges by (key, order) and stored (``scan.deal``); a range is a chunk.
2. Whatever came before a chunk, all that matters is how many installs and uninstalls the open batch holds by
   then. The first batch to close in a chunk closes on one of its first ``T_i`` installs or ``T_u``
   uninstalls; for each of them a chunk says how many batches it closes and what its open batch holds at its
   end. This summary has ``T_i + T_u`` entries however many rows the chunk has.
3. The summaries of a key are followed from chunk to chunk, one step each.
4. Every chunk numbers its rows and batches from what its first key brings along. Ranges are
   contiguous, so at most one key comes into a chunk and one goes on from it: the table of
   them has at most two rows per range, the bound under which it is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.constants import (
    EVENT_INSTALL, EVENT_UNINSTALL, INSTALL_THRESHOLD, TOP_APPS, UNINSTALL_THRESHOLD)
from eventide.functions.predicates import indicator
from eventide.functions.render import top_apps_line
from eventide.operators.scan import CHUNK, deal, join_on
from eventide.session import materialize, python_workers_can_import

_SUMMARY = ("`{key}` {kind}, _at long, rows long, installs long, uninstalls long, at_i array<long>, at_u array<long>, "
            "open_i array<long>, open_u array<long>, closes array<long>")
_ENTRY = "`{key}` {kind}, _at long, _rn long, _i long, _u long, _b long, _goes_on boolean, _total long"


def _chain(inst, unin, ti: int, tu: int):
    """Over the installs and uninstalls of one key in a chunk: their rows, and for each of them, if it closed a batch, how
    many batches close from it on, and at which one the last does."""
    import numpy as np
    rows = np.flatnonzero(inst | unin)
    side = inst[rows]
    ci, cu, n = np.cumsum(side), np.cumsum(~side), len(rows)
    pos_i, pos_u = np.flatnonzero(side), np.flatnonzero(~side)

    def nth(pos, wanted):
        return np.where(wanted <= len(pos), np.append(pos, n)[np.minimum(wanted - 1, len(pos))], n)

    nxt = np.append(np.minimum(nth(pos_i, ci + ti), nth(pos_u, cu + tu)), n)
    last, closes = np.append(np.where(nxt[:n] < n, nxt[:n], np.arange(n)), n), np.append(np.where(nxt[:n] < n, 2, 1), 0)
    while True:                                     # pointer doubling
        further = last[last]
        if (further == last).all():
            return rows, ci, cu, pos_i, pos_u, nxt, last, closes
        last, closes = further, closes + closes[last] - 1


def _segments(keys):
    """Bounds of the runs of equal values of a sorted column (NULLs and NaNs are equal)."""
    import numpy as np
    import pyarrow.compute as pc
    if not len(keys):
        return []
    codes = pc.dictionary_encode(keys, null_encoding="encode")
    codes = (codes.combine_chunks() if hasattr(codes, "combine_chunks") else codes)
    codes = (codes.chunk(0) if hasattr(codes, "chunk") else codes).indices.to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1, [len(codes)]])
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def _chunks(batches):
    """The chunks of a task, each as one table: chunks fit a task, and a task may hold several."""
    import pyarrow as pa
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        for a, b in _segments(table.column(CHUNK)):
            yield table.slice(a, b - a)


def _flags(table):
    return [table.column(c).to_numpy() == 1 for c in ("is_install", "is_uninstall")]


def _summaries(batches, key: str, ti: int, tu: int):
    """Step 2: one row per key and chunk."""
    import numpy as np
    import pyarrow as pa
    for table in _chunks(batches):
        inst, unin = _flags(table)
        out, firsts = [], []
        for a, b in _segments(table.column(key)):
            rows, ci, cu, pos_i, pos_u, _, last, closes = _chain(inst[a:b], unin[a:b], ti, tu)
            entry = np.concatenate([pos_i[:ti], pos_u[:tu]])
            end = last[entry]
            n_i, n_u = int(inst[a:b].sum()), int(unin[a:b].sum())
            out.append((b - a, n_i, n_u, rows[pos_i[:ti]], rows[pos_u[:tu]], n_i - ci[end], n_u - cu[end], closes[entry]))
            firsts.append(a)
        at = table.column(CHUNK)[0].as_py()
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [table.column(key).take(pa.array(firsts)).combine_chunks(), pa.array([at] * len(out), pa.int64())]
            + [pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(c, pa.list_(pa.int64())) for c in cols[3:]],
            names=[key, "_at", "rows", "installs", "uninstalls", "at_i", "at_u", "open_i", "open_u", "closes"])


def _followed(batches, key: str, ti: int, tu: int):
    """Step 3: summaries sorted by key and chunk; what the open batch holds when the key comes into each chunk.
    Only chunks that the key comes into or goes on from are given."""
    import pyarrow as pa
    none, now, held, state = object(), None, [], None
    now = none

    def close():
        keys, rows = held[0][0], [h[1:] for h in held]
        if len(rows) > 1:
            total = state[3]
            made = [(*r, i + 1 < len(rows), total) for i, r in enumerate(rows)]
            cols = list(zip(*made))
            arrays = [pa.concat_arrays([keys] * len(made))] + [pa.array(c, pa.int64()) for c in cols[:5]] + [
                pa.array(cols[5], pa.bool_()), pa.array(cols[6], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "_at", "_rn", "_i", "_u", "_b", "_goes_on", "_total"])

    for batch in batches:
        names = ("_at", "rows", "installs", "uninstalls", "at_i", "at_u", "open_i", "open_u", "closes")
        rows = list(zip(*[batch.column(c).to_pylist() for c in names]))
        for place, (value, row) in enumerate(zip(batch.column(0).to_pylist(), rows)):
            if value != now:
                if held:
                    yield from close()
                now, held, state = value, [], (0, 0, 0, 0)
            at, n, installs, uninstalls, at_i, at_u, open_i, open_u, closes = row
            rn, i, u, b = state
            held.append((batch.column(0).slice(place, 1), at, rn, i, u, b))
            first_i = at_i[ti - i - 1] if ti - i <= len(at_i) else n
            first_u = at_u[tu - u - 1] if tu - u <= len(at_u) else n
            if min(first_i, first_u) == n:
                state = (rn + n, i + installs, u + uninstalls, b)
            else:
                e = ti - i - 1 if first_i < first_u else len(at_i) + tu - u - 1
                state = (rn + n, open_i[e], open_u[e], b + closes[e])
    if held:
        yield from close()


def _numbered(batches, key: str, names: list[str], ti: int, tu: int):
    """Step 4: the rows of a chunk, sorted, with ``rn``, ``is_boundary``, ``batch_no`` and ``closed``."""
    import numpy as np
    import pyarrow as pa
    for table in _chunks(batches):
        inst, unin = _flags(table)
        rn, boundary, closed = np.arange(1, table.num_rows + 1), np.zeros(table.num_rows, np.int32), np.ones(table.num_rows, bool)
        batch_no = np.empty(table.num_rows, np.int64)
        entry = [table.column(c) for c in ("_rn", "_i", "_u", "_b", "_total")]
        for a, b in _segments(table.column(key)):
            rn0, i, u, b0, total = (0 if c[a].as_py() is None else c[a].as_py() for c in entry)
            rows, ci, cu, pos_i, pos_u, nxt, _, _ = _chain(inst[a:b], unin[a:b], ti, tu)
            at = min(pos_i[ti - i - 1] if ti - i <= len(pos_i) else len(rows), pos_u[tu - u - 1] if tu - u <= len(pos_u) else len(rows))
            found = []
            while at < len(rows):
                found.append(at)
                at = nxt[at]
            boundary[a + rows[found]] = 1
            batch_no[a:b] = 1 + b0 + np.cumsum(boundary[a:b]) - boundary[a:b]
            rn[a:b] += rn0 - a
            # a key that lies in several chunks has closed ``total`` batches, another one those found here
            closed[a:b] = batch_no[a:b] <= (len(found) if entry[4][a].as_py() is None else total)
        out = table.select(names)
        for name, values in (("rn", rn), ("is_boundary", boundary), ("batch_no", batch_no), ("closed", closed)):
            out = out.append_column(name, pa.array(values))
        yield from out.to_batches()


def _in_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    python_workers_can_import(df.sparkSession)
    return df.mapInArrow(fn, schema)


def assign_batches(df: DataFrame, key: str, order: Sequence[str], kind: str,
                   install_value: str = EVENT_INSTALL, uninstall_value: str = EVENT_UNINSTALL,
                   install_threshold: int = INSTALL_THRESHOLD,
                   uninstall_threshold: int = UNINSTALL_THRESHOLD,
                   ranges: int | None = None) -> DataFrame:
    """Every row with ``rn``, ``is_install``, ``is_uninstall``, ``batch_no``
    (1-based), ``is_boundary`` (the row closes its batch) and ``closed``
    (its batch has closed). ``ranges`` is the number of chunks the rows are
    dealt into (see ``scan.deal``). NULL order values come first, as in a window."""
    if install_threshold < 1 or uninstall_threshold < 1:
        raise ValueError("thresholds must be at least 1")
    base = df.withColumns({"is_install": indicator(kind, install_value),
                           "is_uninstall": indicator(kind, uninstall_value)})
    dealt = deal(base, [key], list(order), ranges)
    ti, tu, kind_of = install_threshold, uninstall_threshold, df.schema[key].dataType.simpleString()
    by = [F.col(c).asc_nulls_first() for c in (CHUNK, key, *order)]
    flags = dealt.select(CHUNK, key, *[c for c in order if c != key], "is_install", "is_uninstall").sortWithinPartitions(*by)
    summaries = _in_arrow(flags.select(CHUNK, key, "is_install", "is_uninstall"),
                          lambda batches: _summaries(batches, key, ti, tu), _SUMMARY.format(key=key, kind=kind_of))
    entries = _in_arrow(summaries.repartition(key).sortWithinPartitions(F.col(key).asc_nulls_first(), "_at"),
                        lambda batches: _followed(batches, key, ti, tu), _ENTRY.format(key=key, kind=kind_of))
    entries = materialize(entries.withColumnRenamed("_at", CHUNK).withColumn(CHUNK, F.col(CHUNK).cast("int")), "entries")
    names = base.columns
    rows = join_on(dealt, F.broadcast(entries), [CHUNK, key], "left").sortWithinPartitions(*by)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return _in_arrow(rows, lambda batches: _numbered(batches, key, names, ti, tu),
                     f"{fields}, rn long, is_boundary int, batch_no long, closed boolean")


def batch_summary(tagged: DataFrame, key: str, time_col: str, id_col: str,
                  keep_open: bool = False) -> DataFrame:
    """Per (key, batch): rows, installs, uninstalls and the closing row."""
    rows = tagged if keep_open else tagged.filter("closed")
    last = F.max_by(F.struct(F.col("rn"), F.col(time_col), F.col(id_col)), F.col("rn"))
    out = rows.groupBy(key, "batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("is_install").cast("long").alias("installs"),
        F.sum("is_uninstall").cast("long").alias("uninstalls"),
        F.bool_and("closed").alias("closed"),
        last.alias("_last"))
    return out.select(key, "batch_no", "n_rows", "installs", "uninstalls", "closed",
                      F.col("_last.rn").alias("close_rn"),
                      F.unix_millis(F.col(f"_last.{time_col}")).alias("close_ts_ms"),
                      F.col(f"_last.{id_col}").alias("close_id"))


def app_counts(tagged: DataFrame, key: str, app: str, keep_open: bool = False) -> DataFrame:
    """AGG-13: installs and uninstalls per (key, batch, app)."""
    rows = tagged if keep_open else tagged.filter("closed")
    return rows.groupBy(key, "batch_no", app).agg(
        F.sum("is_install").cast("long").alias("installs"),
        F.sum("is_uninstall").cast("long").alias("uninstalls"))


def top_apps(counts: DataFrame, key: str, app: str, top_n: int = TOP_APPS) -> DataFrame:
    """K-1: top ``top_n`` apps by installs and by uninstalls per (key, batch);
    count desc, then app asc. Apps with no such event are not ranked.
    Output: key, batch_no, kind, rank, app, n."""
    # one read of the counts: each row becomes its install and uninstall entry
    sides = F.explode(F.array(
        F.struct(F.lit("install").alias("kind"), F.col("installs").alias("n")),
        F.struct(F.lit("uninstall").alias("kind"), F.col("uninstalls").alias("n"))))
    per_kind = (counts.select(key, "batch_no", app, sides.alias("_s"))
                .select(key, "batch_no", app, "_s.kind", "_s.n")
                .filter(F.col("n") > 0))
    w = Window.partitionBy(key, "batch_no", "kind").orderBy(F.desc("n"), F.asc(app))
    return (per_kind.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= top_n))


def top_apps_report(top: DataFrame, key: str, app: str) -> DataFrame:
    """F-10: one report line per (key, batch) from the ranked lists."""
    def ranked(kind: str) -> Column:
        items = F.collect_list(F.when(F.col("kind") == kind, F.struct(
            F.col("rank"), F.col(app).cast("string").alias("name"), F.col("n"))))
        return F.transform(F.array_sort(items), lambda x: F.struct(x["name"].alias("name"),
                                                                   x["n"].alias("n")))
    grouped = top.groupBy(key, "batch_no").agg(ranked("install").alias("_i"),
                                                ranked("uninstall").alias("_u"))
    return grouped.select(key, "batch_no", top_apps_line(F.col(key).cast("string"), F.col("_i"),
                                                         F.col("_u")).alias("report"))
