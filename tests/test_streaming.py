"""Batch = stream parity and streaming edge cases (late rows, flushing by a
later row, processing-time report)."""

import time


from helpers import T0_MS, at, rows
from eventide.plans import jobs
from eventide.streaming import io as sio
from eventide.streaming import jobs as sjobs
from test_fixtures import CLICKS_F9, ORDERS, DELIVERIES


def _write(spark, tmp_path, name, data, schema, files=1):
    """Write rows as ``files`` parquet files created one after another, so
    the file source reads them in that order (one per micro-batch)."""
    folder = tmp_path / name
    per = -(-len(data) // files)
    for i in range(files):
        part = data[i * per:(i + 1) * per]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)
    return str(folder), spark.createDataFrame(data, schema).schema


def test_stream_click_jumps_matches_batch(spark, tmp_path):
    data = [("u1", 0, 6), ("u1", 1, 6), ("u1", 2, 0), ("u1", 3, 5), ("u1", 4, 9),
            ("u2", 0, 5), ("u2", 1, 0), ("u2", 2, 6), ("u3", 0, 0)]
    data = [(u, at(s * 1000), s, c) for u, s, c in sorted(data, key=lambda r: r[1])]
    path, schema = _write(spark, tmp_path, "clicks", data,
                          "user_id STRING, time TIMESTAMP, ord INT, click_count BIGINT", files=3)
    st = sio.event_time(sio.read_parquet_stream(spark, path, schema, 1), "time", 1000)
    out = sio.run_to_table(sjobs.click_jumps(st, "user_id", ["time", "ord"], "click_count", ["ord"],
                                             last_name="last_clicks_count"), "jumps_test")
    batch = jobs.click_jumps(spark.createDataFrame(data, schema))
    cols = ("user_id", "ord", "click_count", "last_clicks_count")
    assert rows(out, *cols) == rows(batch, *cols)


def test_stream_store_batches_match_batch(spark, tmp_path):
    kinds = ["install", "install", "page_view", "install", "uninstall", "install", "uninstall",
             "install", "install", "uninstall", "uninstall", "install"]
    data = [("S1", app, k, at(i * 1000), i) for i, (app, k) in
            enumerate(zip("ABAABABCABBA", kinds))]
    schema = "store STRING, app_id STRING, event_type STRING, event_time TIMESTAMP, ord INT"
    path, sch = _write(spark, tmp_path, "store", data, schema, files=4)
    st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1), "event_time", 1000)
    out = sio.run_to_table(sjobs.store_batches(st, "store", ["event_time", "ord"], "event_type",
                                               "app_id", 3, 2), "store_test")
    top, _errors = jobs.store_reports(spark.createDataFrame(data, schema), 3, 2)
    cols = ("batch_no", "kind", "rank", "n")
    assert rows(out, *cols, "app") == rows(top.withColumnRenamed("app_id", "app"), *cols, "app")


def test_stream_windows_drop_late_rows_and_flush(spark, tmp_path):
    # batches 1-2: rows in window [0, 10 s); batch 3: a row at 25 s moves the
    # watermark to 24 s; batch 4: filler; batch 5: a late row at 3 s (late
    # rows are filtered with the previous batch's watermark, so it must come
    # two batches later); batch 6: a row far ahead closes [20 s, 30 s).
    data = [("a", at(1000)), ("a", at(2000)), ("b", at(25000)), ("b", at(26000)),
            ("a", at(3000)), ("a", at(999_000))]
    path, schema = _write(spark, tmp_path, "err", data, "store STRING, event_time TIMESTAMP", files=6)
    st = sio.event_time(sio.read_parquet_stream(spark, path, schema, 1), "event_time", 1000)
    out = sio.run_to_table(sjobs.error_windows(st, "event_time", "store"), "err_test")
    got = rows(out, "window_start_ms", "store", "n")
    assert [(s - T0_MS, k, n) for s, k, n in got] == [(0, "a", 2), (20000, "b", 2)]


def test_stream_acronym_periods_match_batch(spark, tmp_path):
    data = [("a", 14390000), ("b", 14391000), ("a", 14399000), ("c", 14400000),
            ("c", 14401000), ("a", 43200000), ("b", 104400000)]
    rows_in = [(str(i), at(ms), "hw", a) for i, (a, ms) in enumerate(data)]
    rows_in.append(("sentinel", at(30 * 86_400_000), "zz", "x"))
    schema = "commentId STRING, time TIMESTAMP, topic STRING, acronym STRING"
    path, sch = _write(spark, tmp_path, "comments", rows_in, schema, files=2)
    st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1), "time", 10000)
    out = sio.run_to_table(sjobs.acronym_periods(st, "topic", "time", "acronym"), "periods_test")
    comments = spark.createDataFrame([(str(i), ms, "u", "hw", a) for i, (a, ms) in enumerate(data)],
                                     "commentId STRING, time BIGINT, user STRING, topic STRING, acronim STRING")
    cols = ("topic", "acronym", "acronyms_counter", "total_comments_counter",
            "label_time_of_day", "closed_at_ms", "period_time_of_day")
    assert rows(out, *cols) == rows(jobs.acronym_periods(comments), *cols)


def test_stream_busiest_window_matches_batch(spark, tmp_path):
    data = [(u, at(ms)) for u, ms in CLICKS_F9] + [("late", at(3_600_000))]
    path, schema = _write(spark, tmp_path, "clicks9", data, "user_id STRING, click_time TIMESTAMP", 2)
    st = sio.event_time(sio.read_parquet_stream(spark, path, schema, 1), "click_time", 1000)
    out = sio.run_to_table(sjobs.busiest_window(st, "click_time"), "busiest_test")
    assert rows(out, "w_start_ms", "w_end_ms", "click_count") == [(T0_MS + 1000, T0_MS + 3000, 4)]


def test_stream_delivery_join(spark, tmp_path):
    o = [(i, at(0).fromisoformat(t.replace("Z", "+00:00"))) for i, t in ORDERS]
    d = [(i, oid, at(0).fromisoformat(t.replace("Z", "+00:00"))) for i, oid, t in DELIVERIES]
    opath, osch = _write(spark, tmp_path, "orders", o, "order_key STRING, order_ts TIMESTAMP")
    dpath, dsch = _write(spark, tmp_path, "deliveries", d,
                         "delivery_id STRING, order_id STRING, delivery_ts TIMESTAMP")
    ends = sio.EndOfInput(spark, osch, "order_ts"), sio.EndOfInput(spark, dsch, "delivery_ts")
    os_ = sio.event_time(sio.read_parquet_stream(spark, opath, osch, end=ends[0]), "order_ts", 1000)
    ds_ = sio.event_time(sio.read_parquet_stream(spark, dpath, dsch, end=ends[1]), "delivery_ts", 1000)
    out = sio.run_to_table(sjobs.delivery_matches(os_, ds_, "order_key", "order_ts", "order_id",
                                                  "delivery_ts"), "deliveries_test", ends=ends)
    got = rows(out.filter("status in ('in_time', 'late')"), "order_id", "status")
    assert got == [("267e8761", "in_time"), ("267e9061", "late"), ("267e9361", "late"),
                   ("675e3421", "in_time")]


def test_quiet_report_after_gap(spark, tmp_path):
    data = [("k", "late"), ("k", "in_time"), ("k", "late")]
    path, schema = _write(spark, tmp_path, "quiet", data, "key STRING, status STRING")
    st = sio.read_parquet_stream(spark, path, schema)
    q = sio.start(sjobs.quiet_report(st, "key", "status", gap_ms=1500), "quiet_test", sink="memory",
                  processing_time="500 milliseconds")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("quiet_test").count() == 0:
            time.sleep(0.5)
        assert rows(spark.table("quiet_test"), "status", "n") == [("in_time", 1), ("late", 2)]
    finally:
        q.stop()


def test_stream_click_sessions_match_batch(spark, tmp_path):
    from test_fixtures import CLICKS_F3
    data = [(u, at(ms)) for u, ms in CLICKS_F3] + [("later", at(3_600_000))]
    path, schema = _write(spark, tmp_path, "clicks3", data, "user_id STRING, click_time TIMESTAMP", 2)
    st = sio.event_time(sio.read_parquet_stream(spark, path, schema, 1), "click_time", 1000)
    out = sio.run_to_table(sjobs.click_sessions(st, "click_time"), "sessions_test")
    batch = jobs.click_sessions(spark.createDataFrame(data, schema))
    cols = ("session_start_ms", "session_end_ms", "clicks")
    assert rows(out, *cols) == [r for r in rows(batch, *cols) if r[0] < T0_MS + 3_600_000]


def test_stream_fan_out_two_outputs(spark, tmp_path):
    data = [("a", "error"), ("b", "install"), ("c", "error")]
    path, schema = _write(spark, tmp_path, "fan", data, "id STRING, kind STRING")
    seen = {"errors": [], "rest": []}

    def errors(batch, _epoch):
        seen["errors"] += [r.id for r in batch.filter("kind = 'error'").collect()]

    def rest(batch, _epoch):
        seen["rest"] += [r.id for r in batch.filter("kind != 'error'").collect()]

    q = sio.fan_out_batches(sio.read_parquet_stream(spark, path, schema), "fan_test", errors, rest,
                            available_now=True)
    q.awaitTermination()
    assert sorted(seen["errors"]) == ["a", "c"] and seen["rest"] == ["b"]


def test_stream_deliveries_match_batch(spark, tmp_path):
    """A repeated order (two days apart), a delivery before its order, one
    far beyond the deadline and one without an order: one row each, as in batch."""
    import datetime as dt
    from eventide.operators import joins
    t = lambda d: dt.datetime(2023, 6, d, tzinfo=dt.timezone.utc)
    orders = [("o1", t(1)), ("o9", t(20)), ("o1", t(3)), ("o5", t(12)), ("o9", t(18))]
    deliveries = [("d1", "o1", t(2)), ("d2", "missing", t(3)), ("d3", "o9", t(29)), ("d4", "o9", t(19)), ("d5", "o1", t(6)), ("d6", "o5", t(11))]
    opath, osch = _write(spark, tmp_path, "o2", orders, "order_key STRING, order_ts TIMESTAMP", 2)
    dpath, dsch = _write(spark, tmp_path, "d2", deliveries,
                         "delivery_id STRING, order_id STRING, delivery_ts TIMESTAMP", 3)
    ends = sio.EndOfInput(spark, osch, "order_ts"), sio.EndOfInput(spark, dsch, "delivery_ts")
    day = 24 * 3_600_000
    os_ = sio.event_time(sio.read_parquet_stream(spark, opath, osch, 1, ends[0]), "order_ts", 30 * day)
    ds_ = sio.event_time(sio.read_parquet_stream(spark, dpath, dsch, 1, ends[1]), "delivery_ts", 30 * day)
    out = sio.run_to_table(sjobs.delivery_matches(os_, ds_, "order_key", "order_ts", "order_id", "delivery_ts",
                                                  after_days=30, before_days=5), "deliveries2", ends=ends)
    batch = joins.classify_deliveries(spark.createDataFrame(deliveries, dsch), spark.createDataFrame(orders, osch),
                                      "order_id", "order_key", "order_ts", "delivery_ts")
    want = [(d, "unmatched" if s_ == "orphan" else s_) for d, s_ in rows(batch, "delivery_id", "status")]
    assert rows(out, "delivery_id", "status") == want and {s_ for _, s_ in want} == {
        "in_time", "late", "before_order", "unmatched"}


def test_stream_previous_value_in_event_order(spark, tmp_path):
    """Files in any order, NULL counts, rows held over several watermarks and
    a row that is late: the same as batch without the late row."""
    import random
    rnd = random.Random(8)
    data = [(rnd.choice(["u1", "u2", "u3"]), at(i * 1000), i, rnd.choice([None, 0, 3, 9, 20])) for i in range(120)]
    schema = "user_id STRING, time TIMESTAMP, ord INT, click_count BIGINT"
    # file order: blocks swapped, each row within 40 s of its place
    blocks = [data[i:i + 20] for i in range(0, 120, 20)]
    mixed = [r for k in (1, 0, 3, 2, 5, 4) for r in blocks[k]]
    late = ("u1", at(500), 999, 0)
    path, sch = _write(spark, tmp_path, "ev", mixed + [late], schema, files=6)
    end = sio.EndOfInput(spark, sch, "time")
    st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1, end), "time", 45_000)
    out = sio.run_to_table(sjobs.click_jumps(st, "user_id", ["time", "ord"], "click_count", ["ord"],
                                             last_name="last_clicks_count", event_time="time"), "ordered", ends=(end,))
    batch = jobs.click_jumps(spark.createDataFrame(data, sch))
    text = lambda df: sorted((r.user_id, r.ord, str(r.click_count), str(r.last_clicks_count)) for r in df.collect())
    assert text(out) == text(batch)


def test_stream_store_batches_random_match_batch(spark, tmp_path):
    import random
    rnd = random.Random(5)
    data = [(s, rnd.choice("ABCD"), rnd.choice(["install", "uninstall", "page_view", "install"]),
             at(i * 1000), i) for i in range(300) for s in [rnd.choice(["S1", "S2"])]]
    schema = "store STRING, app_id STRING, event_type STRING, event_time TIMESTAMP, ord INT"
    path, sch = _write(spark, tmp_path, "store_rand", data, schema, files=5)
    st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1), "event_time", 1000)
    out = sio.run_to_table(sjobs.store_batches(st, "store", ["event_time", "ord"], "event_type",
                                               "app_id", 7, 4), "store_rand_test")
    top, _errors = jobs.store_reports(spark.createDataFrame(data, schema), 7, 4)
    cols = ("store", "batch_no", "kind", "rank", "n", "app")
    assert rows(out, *cols) == rows(top.withColumnRenamed("app_id", "app"), *cols)


def test_stream_booking_min_max_matches_batch(spark, tmp_path):
    from test_fixtures import BOOKINGS
    data = [(g, at(ms), n) for g, ms, n in BOOKINGS] + [("Later", at(3_600_000), 0)]
    schema = "geo_region STRING, event_time TIMESTAMP, booking_count BIGINT"
    path, sch = _write(spark, tmp_path, "bookings", data, schema, files=3)
    st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1), "event_time", 1000)
    out = sio.run_to_table(jobs.booking_min_max(st), "bookings_test")
    batch = jobs.booking_min_max(spark.createDataFrame(data, schema))
    cols = ("geo_region", "window_start_ms", "window_end_ms", "min_value", "max_value")
    assert rows(out, *cols) == [r for r in rows(batch, *cols) if r[0] != "Later"]


def test_stream_running_counts_and_concat(spark, tmp_path):
    from test_fixtures import TEXTS
    tpath, tsch = _write(spark, tmp_path, "texts", [(i, t) for i, (t,) in enumerate(TEXTS)],
                         "ord INT, text STRING", files=2)
    q1 = sio.start(sjobs.article_counts(sio.read_parquet_stream(spark, tpath, tsch, 1)),
                   "articles_test", sink="memory", output_mode="complete", available_now=True)
    q1.awaitTermination()
    assert rows(spark.table("articles_test"), "token", "count") == [("a", 1), ("the", 3)]
    data = [(0, "en", "car, bus, "), (1, "ru", "машина, "), (2, "en", "course, "), (3, "en", "house, ")]
    lpath, lsch = _write(spark, tmp_path, "langs", data, "ord INT, language STRING, token STRING", 2)
    q2 = sio.start(sjobs.language_concat(sio.read_parquet_stream(spark, lpath, lsch, 1)),
                   "concat_test", sink="memory", output_mode="complete", available_now=True)
    q2.awaitTermination()
    assert rows(spark.table("concat_test"), "language", "text") == [
        ("en", "car, bus, course, house, "), ("ru", "машина, ")]


def test_console_sink_runs(spark, tmp_path):
    path, schema = _write(spark, tmp_path, "console", [("x", 1)], "k STRING, n INT")
    q = sio.start(sio.read_parquet_stream(spark, path, schema), "console_test", sink="console",
                  available_now=True)
    q.awaitTermination()
    assert q.exception() is None


def test_print_stream_prints_every_row(spark, tmp_path, capsys):
    data = [("x" * 40, i) for i in range(45)]
    path, schema = _write(spark, tmp_path, "printed", data, "k STRING, n INT", files=2)
    q = sio.print_stream(sio.read_parquet_stream(spark, path, schema, 1), "print_test", available_now=True)
    q.awaitTermination()
    assert sorted(capsys.readouterr().out.splitlines()) == sorted(f"k={k} n={n}" for k, n in data)


def _drain(df, checkpoint, out):
    """Run a stream until its input is drained; the progress of each micro-batch."""
    q = sio.start(df, "drained", "parquet", out, checkpoint=checkpoint, available_now=True)
    q.awaitTermination()
    return q.recentProgress


def test_waiting_rows_are_stored_and_read_once(spark, tmp_path):
    """S-13: over many micro-batches a waiting window is written when rows come to it and removed once; the
    work does not grow with the rows that wait elsewhere."""
    from eventide.streaming.replay import replay
    data = [(f"u{i % 5}", at(i * 1000), i, i % 11) for i in range(600)]
    df = spark.createDataFrame(data, "user_id STRING, time TIMESTAMP, ord INT, click_count BIGINT")
    st, _ = replay(df, "time", delay_ms=1000, stretch=60_000)
    held = sjobs.in_event_order(st, ["user_id"], "time", ["time", "ord", "click_count"], bucket_ms=10_000)
    progress = [p for p in _drain(held, str(tmp_path / "c"), str(tmp_path / "o")) if p["stateOperators"]]
    ops = [p["stateOperators"][0] for p in progress]
    windows_in = {(u, t.timestamp() // 10) for u, t, *_ in data}
    assert len([p for p in progress if p["numInputRows"]]) == 10
    assert sum(o["numRowsUpdated"] for o in ops) == len(windows_in)          # a file holds whole windows here
    assert sum(o["numRowsRemoved"] for o in ops) == len(windows_in) - ops[-1]["numRowsTotal"]
    assert max(o["numRowsTotal"] for o in ops) <= 2 * 5 * 6 and ops[-1]["numRowsTotal"] <= 10


def test_watermark_that_moves_drops_exactly_the_late_rows(spark, tmp_path):
    """S-1, S-10: files cut by time, some rows two files late; the result is that of the rows whose window the
    watermark of the micro-batch before had not passed."""
    from pyspark.sql import functions as F

    from eventide.operators import windows
    from eventide.streaming.replay import replay
    late = lambda i: i % 7 == 3
    data = [(i, at(i * 1000), "a" if i % 3 else "b") for i in range(400)]
    df = spark.createDataFrame(data, "id INT, time TIMESTAMP, store STRING")
    st, end = replay(df, "time", delay_ms=2000, stretch=50_000, held_up=(F.expr("id % 7 = 3"), 2))
    out = sio.run_to_table(sjobs.error_windows(st, "time", "store", 20_000), "moving", ends=(end,))
    slot = lambda r: r[1].timestamp() * 1000 // 50_000 + (2 if late(r[0]) else 0)
    slots = sorted({slot(r) for r in data})
    top = {s: max(int(r[1].timestamp() * 1000) for r in data if slot(r) == s) for s in slots}
    kept = []
    for r in data:
        before = [top[s] for s in slots[:max(0, slots.index(slot(r)) - 1)]]
        wm = max(before) - 2000 if before else 0
        if (int(r[1].timestamp() * 1000) // 20_000 + 1) * 20_000 > wm:
            kept.append(r)
    want = windows.window_counts(spark.createDataFrame(kept, df.schema), "time", 20_000, keys=["store"])
    cols = ("window_start_ms", "window_end_ms", "store", "n")
    assert 0 < len(data) - len(kept) < sum(map(late, range(400))) and rows(out, *cols) == rows(want, *cols)


def test_state_of_a_quiet_key_expires(spark, tmp_path):
    """S-11: with a time to live, the previous value of a key without rows goes; the key starts anew."""
    schema = "user_id STRING, time TIMESTAMP, ord INT, click_count BIGINT"
    path, sch = _write(spark, tmp_path, "ttl", [("u", at(0), 0, 9)], schema)
    st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1), "time", None)
    out = sjobs.click_jumps(st, "user_id", ["time", "ord"], "click_count", ["ord"], ttl_ms=3000)
    q = sio.start(out, "ttl_test", sink="memory", processing_time="300 milliseconds")

    def wait_for(done):
        until = time.time() + 40
        while not done() and time.time() < until:
            time.sleep(0.3)
        return done()
    try:
        seen = lambda n: spark.table("ttl_test").count() == n
        held = lambda: q.lastProgress["stateOperators"][0]["numRowsTotal"]
        assert wait_for(lambda: seen(1)) and wait_for(lambda: held() == 0)      # the dead key's state goes
        _write(spark, tmp_path, "ttl", [("u", at(1000), 1, 8)], schema)
        assert wait_for(lambda: seen(2))
        assert rows(spark.table("ttl_test"), "ord", "click_count", "last_value") == [(0, 9, 0), (1, 8, 0)]
    finally:
        q.stop()


def test_fan_out_repeats_a_failed_epoch_without_doubling(spark, tmp_path):
    """SNK-3: the second writer fails once; the restarted query writes the epoch anew."""
    import pytest
    data = [(i, "error" if i % 3 == 0 else "install") for i in range(30)]
    path, schema = _write(spark, tmp_path, "twice", data, "id INT, kind STRING", files=3)
    st = sio.read_parquet_stream(spark, path, schema, 1)
    root, checkpoint, calls = str(tmp_path / "root"), str(tmp_path / "ckpt"), []

    def rest(batch):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("writer lost")
        return batch.filter("kind <> 'error'")

    outputs = {"errors": lambda b: b.filter("kind = 'error'"), "rest": rest}
    with pytest.raises(Exception, match="writer lost"):
        sio.fan_out_tables(st, "twice1", root, outputs, checkpoint).awaitTermination()
    half = sio.read_fan_out(spark, root, "errors", schema)
    assert rows(half, "epoch", "id") == [(0, i) for i, k in data[:10] if k == "error"]     # epoch 1 is not done
    sio.fan_out_tables(st, "twice2", root, outputs, checkpoint).awaitTermination()
    for out, kinds in (("errors", ["error"]), ("rest", ["install"])):
        assert rows(sio.read_fan_out(spark, root, out, schema), "id") == [(i,) for i, k in data if k in kinds]
    assert len(calls) == 4


def test_sessions_over_all_rows_merge_buckets(spark, tmp_path):
    """S-6: rows at bucket borders, gaps of exactly and just over the gap, a hot instant; no stage but the bucket
    count sees the rows."""
    import random

    from eventide.operators import sessions
    rnd = random.Random(3)
    ms, times = 0, []
    for _ in range(250):
        ms += rnd.choice([0, 1, 500, 2999, 3000, 3001, 9000])
        times.append(ms)
    data = [(i, at(t)) for i, t in enumerate(times)] + [(1000 + i, at(times[100])) for i in range(300)]
    df = spark.createDataFrame(data, "id INT, time TIMESTAMP")
    from eventide.streaming.replay import replay
    st, end = replay(df, "time", delay_ms=1000, stretch=70_000)
    out = sio.run_to_table(sjobs.click_sessions(st, "time", 3000), "merged", ends=(end,))
    cols = ("session_start_ms", "session_end_ms", "clicks")
    assert rows(out, *cols) == rows(sessions.global_sessions(df, "time", 3000, count_name="clicks"), *cols)


def test_first_arrivals_and_bounded_join_state(spark, tmp_path):
    """AGG-8 and J-2: repeated orders are joined once; orders and deliveries leave the state when the
    bounds have passed, and whoever is without a partner within them is unmatched."""
    import datetime as dt

    from pyspark.sql import functions as F

    from eventide.streaming.replay import replay
    day = 24 * 3_600_000
    t = lambda d: dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=d)
    orders = spark.createDataFrame([(i, t(i)) for i in range(200)], "o INT, ot TIMESTAMP")
    gaps = [0, 1, 3, 4, 30, 31, -1, -5, -6]
    deliveries = spark.createDataFrame([(n, n % 200, t(n % 200 + gaps[n % len(gaps)])) for n in range(400)], "d INT, r INT, dt TIMESTAMP")
    os_, end_o = replay(orders, "ot", delay_ms=4 * day, stretch=20 * day, copies=(F.lit(True), 2 * day))
    ds_, end_d = replay(deliveries, "dt", delay_ms=1000, stretch=20 * day)
    out = sjobs.delivery_matches(os_, ds_, "o", "ot", "r", "dt", after_days=30, before_days=5, first="arrival")
    checkpoint, path = str(tmp_path / "c"), str(tmp_path / "o")
    progress = _drain(out, checkpoint, path)
    most = max(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress)
    end_o.write(), end_d.write()
    _drain(out, checkpoint, path)
    status = {0: "in_time", 1: "in_time", 3: "in_time", 4: "late", 30: "late", 31: "unmatched", -1: "before_order", -5: "before_order", -6: "unmatched"}
    got = rows(spark.read.parquet(path).filter("d < 1000 AND dt < '2100-01-01'"), "d", "status")
    assert got == [(n, status[gaps[n % len(gaps)]]) for n in range(400)]
    assert most < 500       # of 400 orders that come, 200 keys to remember and 400 deliveries


def test_click_jumps_keep_keys_of_one_part_apart(spark, tmp_path):
    """Many keys in few parts, a null key and null values, over several micro-batches: like the batch operator."""
    import random
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", "c", None]), at(60_000 * i), i, rng.choice([None, 0, 1, 5, 9])) for i in range(120)]
    path, sch = _write(spark, tmp_path, "parts", data, "user_id STRING, time TIMESTAMP, ord INT, click_count BIGINT", files=4)
    out = {}
    for parts in (1, 2, 128):
        st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1), "time", None)
        got = sio.run_to_table(sjobs.click_jumps(st, "user_id", ["time", "ord"], "click_count", ["ord"], parts=parts), f"parts{parts}")
        out[parts] = rows(got, "ord", "user_id", "click_count", "last_value")
    last, want = {}, []
    for user, _t, i, n in data:
        old = last.get(user, 0)
        if n is not None and (n == 0 or old is not None and n - old > 5):
            want.append((i, user, n, old))
        last[user] = n
    assert out[1] == out[2] == out[128] == sorted(want) and len(want) > 20


def test_an_input_is_ended_in_the_same_run(spark, tmp_path, monkeypatch):
    """The row that ends an input comes behind its files, so one run brings out every window, none twice,
    and no state is loaded anew; the files before it are still read one by one."""
    begun = []
    monkeypatch.setattr(sio, "start", lambda *a, real=sio.start, **k: (begun.append(real(*a, **k)), begun[-1])[1])
    data = [("s1", at(k * 10_000)) for k in range(12)]
    path, sch = _write(spark, tmp_path, "ended", data, "store STRING, event_time TIMESTAMP", files=4)
    end = sio.EndOfInput(spark, sch, "event_time")
    st = sio.event_time(sio.read_parquet_stream(spark, path, sch, 1, end), "event_time", 1000)
    out = sio.run_to_table(sjobs.error_windows(st, "event_time", "store", 20_000), "ended", ends=(end,))
    assert [r.n for r in out.collect()] == [2] * 6
    assert len(begun) == 1
    read = [p["numInputRows"] for p in begun[0].recentProgress if p["numInputRows"]]
    assert read == [3, 3, 3, 3, 1]
