"""Edge cases and brute-force cross-checks (plain Python folds of the
reference's per-row state machines against the distributed operators)."""

import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import T0_MS, at, rows
from eventide import constants as K
from eventide.functions.timefn import time_of_day
from eventide.operators import periods, quality, segments, sessions, weights
from eventide.operators.scan import CHUNK, deal, prefix_sums, previous_values, value_chunk
from eventide.sources import files


def _fold_batches(kinds, ti, tu):
    """Reference trigger semantics: list of (batch_no, closed) per row."""
    out, batch, ci, cu, pending = [], 1, 0, 0, []
    for k in kinds:
        ci += k == "install"
        cu += k == "uninstall"
        pending.append(batch)
        if ci >= ti or cu >= tu:
            out += [(b, True) for b in pending]
            pending, batch, ci, cu = [], batch + 1, 0, 0
    return out + [(b, False) for b in pending]


@pytest.mark.parametrize("seed,ti,tu,ranges", [
    (1, 3, 2, 1), (2, 5, 3, 4), (3, 1, 1, 9), (4, 7, 4, 70), (5, 40, 30, 150)])
def test_threshold_batches_match_fold(spark, seed, ti, tu, ranges):
    """One range per table up to ranges of one or two rows, whose exits are
    chained over two levels."""
    rnd = random.Random(seed)
    data = []
    for key in ("k0", "k1", None):
        for i in range(rnd.randint(0, 120)):
            data.append((key, i, rnd.choice(["install", "uninstall", "page_view", "install"])))
    df = spark.createDataFrame(data, "store STRING, ord INT, event_type STRING")
    tagged = segments.assign_batches(df, "store", ["ord"], "event_type", install_threshold=ti,
                                     uninstall_threshold=tu, ranges=ranges)
    got = {(r.store, r.ord): (r.batch_no, r.closed) for r in tagged.collect()}
    for key in ("k0", "k1", None):
        kinds = [t for k, _o, t in data if k == key]
        ords = [o for k, o, _t in data if k == key]
        for o, want in zip(ords, _fold_batches(kinds, ti, tu)):
            assert got[(key, o)] == want, (key, o)
    closed = segments.app_counts(tagged, "store", "event_type").groupBy("store", "batch_no").agg(
        F.sum("installs").alias("i"), F.sum("uninstalls").alias("u"))
    assert closed.filter((F.col("i") > ti) | (F.col("u") > tu)).count() == 0


def test_thresholds_on_neighbouring_rows(spark):
    kinds = ["install", "uninstall", "install", "uninstall"]
    df = spark.createDataFrame([("s", i, k) for i, k in enumerate(kinds)],
                               "store STRING, ord INT, event_type STRING")
    t = segments.assign_batches(df, "store", ["ord"], "event_type", install_threshold=2,
                                uninstall_threshold=2)
    assert rows(t, "ord", "batch_no", "closed") == [(0, 1, True), (1, 1, True), (2, 1, True),
                                                    (3, 2, False)]


@pytest.mark.parametrize("kind", ["TIMESTAMP", "DATE", "STRING", "BIGINT"])
def test_threshold_order_types_nulls_and_big_numbers(spark, kind):
    """NULL order values come first; a nullable BIGINT payload beyond 2^53
    comes back exactly."""
    rnd = random.Random(11)
    data = [(None if i % 7 == 0 else i, i, rnd.choice(["install", "uninstall", "page_view"]),
             None if i % 5 == 0 else 9007199254740993 + i) for i in range(90)]
    df = spark.createDataFrame(data, "n INT, id INT, event_type STRING, big BIGINT").withColumn("store", F.lit("s"))
    col = {"TIMESTAMP": F.timestamp_seconds("n"), "DATE": F.date_add(F.lit("2024-01-01"), F.col("n")),
           "STRING": F.lpad(F.col("n").cast("string"), 4, "0"), "BIGINT": F.col("n").cast("long")}[kind]
    df = df.withColumn("t", col)
    want_rows = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = dict(zip([r[1] for r in want_rows], _fold_batches([r[2] for r in want_rows], 4, 3)))
    for ranges in (1, 13):
        got = segments.assign_batches(df, "store", ["t", "id"], "event_type", install_threshold=4,
                                      uninstall_threshold=3, ranges=ranges).collect()
        assert {r.id: (r.batch_no, r.closed) for r in got} == want
        assert {r.id: r.big for r in got} == {r[1]: r[3] for r in data}


def test_scan_over_many_ranges_equals_one(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b", None]), i, rnd.choice([None, 0, 3, 9])) for i in range(500)]
    df = spark.createDataFrame(data, "k STRING, o INT, v INT").repartition(7)
    results = []
    for ranges in (1, 3, 40):
        d = deal(df, ["k"], ["o"], ranges)
        out = previous_values(prefix_sums(d, ["k"], ["o"], {"s": F.col("v")}), ["k"], ["o"],
                              {"p": F.col("v")}, exists="e")
        excl = prefix_sums(d, ["k"], ["o"], {"x": F.col("v")}, inclusive=False)
        results.append((rows(out, "o", "s", "e"), sorted((r.o, str(r.p)) for r in out.collect()), rows(excl, "o", "x")))
    assert results[0] == results[1] == results[2]
    running, prev = {}, {}
    for k, o, v in data:
        x = running.get(k, 0)
        assert (o, x) in results[0][2] and (o, x + (v or 0), k in prev) in results[0][0]
        assert (o, str(prev.get(k))) in results[0][1]
        running[k], prev[k] = x + (v or 0), v


def test_scan_without_keys_and_on_an_empty_table(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "o INT, v INT")
    out = prefix_sums(deal(df, [], ["o"], 6), [], ["o"], {"s": F.col("v")})
    assert rows(out, "o", "s")[-1] == (49, sum(i % 3 for i in range(50)))
    assert prefix_sums(df.limit(0), [], ["o"], {"s": F.col("v")}).count() == 0


def test_ranges_are_even_for_a_hot_key_skewed_in_time(spark):
    """One key of 2.2M rows over a year, all but one of them within a day and
    with many equal times: no range holds more than twice its share."""
    n, ranges = 2_200_000, 20
    day = 86_400_000_000
    df = spark.range(n).select(
        F.lit("hot").alias("k"), F.col("id"),
        F.timestamp_micros(F.when(F.col("id") == 0, F.lit(0)).otherwise(
            F.lit(364 * day) + (F.col("id") % 1000) * 80_000_000)).alias("t"))
    d = deal(df, ["k"], ["t", "id"], ranges)
    sizes = [r["count"] for r in d.groupBy(CHUNK).count().collect()]
    assert max(sizes) <= 2 * n / ranges and len(sizes) == ranges
    last = prefix_sums(d, ["k"], ["t", "id"], {"rn": F.lit(1).cast("long")}).agg(
        F.max("rn"), F.countDistinct("rn"), F.min("rn")).first()
    assert tuple(last) == (n, n, 1)


def test_global_sessions_match_gap_rule(spark):
    rnd = random.Random(3)
    ms = sorted(rnd.randint(0, 200_000) for _ in range(400)) + [300_000, 303_000, 306_001]
    df = spark.createDataFrame([(at(m),) for m in ms], "t TIMESTAMP")
    got = rows(sessions.global_sessions(df, "t", 3000), "session_start_ms", "session_end_ms", "n")
    want, start, last, n = [], ms[0], ms[0], 0
    for m in ms:
        if m - last > 3000:
            want.append((start, last + 3000, n))
            start, n = m, 0
        last, n = m, n + 1
    want.append((start, last + 3000, n))
    assert [(s - T0_MS, e - T0_MS, c) for s, e, c in got] == want
    keyed = sessions.keyed_sessions(df.withColumn("k", F.lit(1)), "t", 3000, ["k"])
    assert rows(keyed, "session_start_ms", "session_end_ms", "n") == got


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "t TIMESTAMP, k STRING")
    assert sessions.global_sessions(empty, "t", 1000).count() == 0
    assert sessions.busiest_window(empty, "t", 2000, 1000, 30000).count() == 0


def test_split_is_a_partition(spark):
    df = spark.createDataFrame([(1, "error"), (2, None), (3, "install"), (4, "error")],
                               "id INT, event_type STRING")
    main, side = quality.split(df, F.col("event_type") == "error")
    assert rows(main, "id") == [(2,), (3,)] and rows(side, "id") == [(1,), (4,)]
    good, bad = quality.quarantine_domain(df, "event_type", K.STORE_EVENT_TYPES)
    assert rows(bad, "id") == [(2,)] and good.count() == 3
    with pytest.raises(Exception):
        quality.check_domain(df, "event_type", K.STORE_EVENT_TYPES).collect()


def test_time_of_day_bounds(spark):
    hours = [0, 3, 4, 11, 12, 16, 17, 23]
    df = spark.createDataFrame([(at(h * 3600_000 + 59_999),) for h in hours], "t TIMESTAMP")
    got = [r[0] for r in df.orderBy("t").select(time_of_day("t")).collect()]
    assert got == ["Midnight", "Midnight", "Mourning", "Mourning", "Day", "Day", "Evening", "Evening"]


def _fold_periods(comments, window_ms, top_n):
    """The reference's window function state machine, in plain Python."""
    def tod(ms):
        h = (ms // 3_600_000) % 24
        return next(lab for lab, lo, hi in K.TIME_OF_DAY if lo <= h < hi)
    out = []
    for topic in sorted({c[0] for c in comments}):
        wins = {}
        for tp, ms, acr in comments:
            if tp == topic:
                wins.setdefault(ms // window_ms, []).append((ms, acr))
        state, total, last = {}, 0, None
        for w in sorted(wins):
            items = wins[w]
            first = min(ms for ms, _a in items)
            cur = tod(first)
            if cur != last:
                if last is not None:
                    top = sorted(state.items(), key=lambda kv: (-kv[1], kv[0]))[:top_n]
                    out += [(topic, a, n, total, cur, first, last) for a, n in top]
                state, total, last = {}, 0, cur
            for _ms, a in items:
                state[a] = state.get(a, 0) + 1
            total += len(items)
    return sorted(out)


def test_periods_match_fold(spark):
    rnd = random.Random(11)
    comments = [(rnd.choice(["hw", "sw"]), rnd.randint(0, 3 * 86_400_000), rnd.choice("abcdefg"))
                for _ in range(300)]
    df = spark.createDataFrame([(tp, at(ms), a) for tp, ms, a in comments],
                               "topic STRING, t TIMESTAMP, acronym STRING")
    got = periods.period_top_acronyms(df, "topic", "t", "acronym", window_ms=3_600_000, top_n=3)
    got = rows(got, "topic", "acronym", "acronyms_counter", "total_comments_counter",
               "label_time_of_day", "closed_at_ms", "period_time_of_day")
    want = _fold_periods([(tp, T0_MS + ms, a) for tp, ms, a in comments], 3_600_000, 3)
    assert got == want


def test_weights_json_and_assignment(spark, tmp_path):
    path = tmp_path / "weights.json"
    doc = {dim: [{"name": n, "probability": p} for n, p in items]
           for dim, items in K.GENERATOR_WEIGHTS.items()}
    doc["eventTimeFreqMillis"] = K.GENERATOR_EVENT_TIME_FREQ_MS
    path.write_text(json.dumps(doc))
    w = files.read_weights(spark, str(path))
    assert w.count() == 12
    assert all(r.valid for r in quality.check_weights(w).collect())
    ps = spark.createDataFrame([(0.0,), (0.25,), (0.2501,), (0.75,), (0.76,)], "p DOUBLE")
    got = rows(weights.assign(ps, "p", w, "stores", "store"), "p", "store")
    assert got == [(0.0, "HuaweiAppStore"), (0.25, "HuaweiAppStore"), (0.2501, "AppleAppStore"),
                   (0.75, "GooglePlay"), (0.76, "RuStore")]
    bad = tmp_path / "bad.json"
    bad.write_text('{"stores": [{"name": "x"}], "appIds": [], "eventTypes": []}')
    with pytest.raises(Exception):
        files.read_weights(spark, str(bad)).collect()


def test_oversized_or_missing_weight_table_is_refused(spark, monkeypatch):
    ps = spark.createDataFrame([(0.5,)], "p DOUBLE")
    with pytest.raises(ValueError):
        weights.assign(ps, "p", weights.weights_frame(spark), "no such dimension", "store")
    monkeypatch.setattr(weights, "MAX_ITEMS", 3)
    with pytest.raises(ValueError):
        weights.assign(ps, "p", weights.weights_frame(spark), "stores", "store")


def test_sorted_csv_round_trip(spark, tmp_path):
    src, dst = str(tmp_path / "in"), str(tmp_path / "out")
    data = [("c3", 30, "u", "hw", "x"), ("c1", 10, "u", "hw", "y"), ("c2", 20, "v", "sw", "z")]
    spark.createDataFrame(data, "a STRING, b BIGINT, c STRING, d STRING, e STRING") \
        .coalesce(1).write.option("header", True).csv(src)
    files.sort_comments_file(spark, src, dst)
    back = files.read_comments(spark, dst)
    assert [r.commentId for r in back.collect()] == ["c1", "c2", "c3"]
    assert back.columns == ["commentId", "time", "user", "topic", "acronim"]


def test_batch_fan_out_and_tee(spark):
    from eventide.sources.sinks import fan_out
    df = spark.createDataFrame([(1, "Hardware"), (2, "Software")], "id INT, topic STRING")
    full, copy = quality.tee(df, F.col("topic") == "Hardware")
    assert full.count() == 2 and rows(copy, "id") == [(1,)]
    seen = []
    fan_out(df, lambda d: seen.append(d.count()), lambda d: seen.append(d.filter("id = 1").count()))
    assert seen == [2, 1]


def test_strict_modes_raise(spark):
    from eventide.functions.timefn import parse_instant
    from eventide.operators import joins
    bad = spark.createDataFrame([("2023-06-15T12:07:13.000Z",), ("not a time",)], "t STRING")
    with pytest.raises(Exception):
        bad.select(parse_instant("t")).collect()
    assert bad.select(parse_instant("t", strict=False).alias("x")).filter("x IS NULL").count() == 1
    orders = spark.createDataFrame([("o1", at(0))], "oid STRING, ot TIMESTAMP")
    dels = spark.createDataFrame([("d1", "o1", at(1000)), ("d2", "o9", at(1000))],
                                 "did STRING, oref STRING, dt TIMESTAMP")
    c = joins.classify_deliveries(dels, orders, "oref", "oid", "ot", "dt")
    assert rows(c, "did", "status") == [("d1", "in_time"), ("d2", "orphan")]
    assert rows(joins.orphans(dels, orders, "oref", "oid"), "did") == [("d2",)]
    with pytest.raises(Exception):
        joins.require_orders(c).collect()


def test_lateness_exactly_deadline_is_in_time(spark):
    from eventide.operators import joins
    orders = spark.createDataFrame([("o1", at(0)), ("o1", at(5000))], "oid STRING, ot TIMESTAMP")
    dels = spark.createDataFrame([("d1", "o1", at(K.LATE_AFTER_SECONDS * 1000)),
                                  ("d2", "o1", at(K.LATE_AFTER_SECONDS * 1000 + 1))],
                                 "did STRING, oref STRING, dt TIMESTAMP")
    c = joins.classify_deliveries(dels, orders, "oref", "oid", "ot", "dt")
    # duplicate order id: the earliest order wins
    assert rows(c, "did", "status") == [("d1", "in_time"), ("d2", "late")]


def test_many_ranges_on_table_data(spark):
    """Previous-value and running-count results of the sf0.001 events do not
    depend on the number of ranges."""
    from eventide.operators import rolling
    from eventide.sources.tables import events
    ev = events(spark, "/root/testdata/sf0.001", "user_id", "event_id", "ts", "value")
    ev = ev.withColumn("c", F.floor("value").cast("long") % 10)
    many = deal(ev, ["user_id"], ["ts", "event_id"], 64)
    a = rolling.previous_jump(many, ["user_id"], ["ts", "event_id"], "c")
    b = rolling.previous_jump(deal(ev, ["user_id"], ["ts", "event_id"], 1), ["user_id"], ["ts", "event_id"], "c")
    assert rows(a, "event_id", "last_value") == rows(b, "event_id", "last_value")
    ra = rolling.running_counts(many, ["user_id"], ["ts", "event_id"])
    rb = rolling.running_counts(ev, ["user_id"], ["ts", "event_id"])
    assert rows(ra, "event_id", "running_count") == rows(rb, "event_id", "running_count")


def test_null_previous_value_is_not_zero(spark):
    from eventide.operators import rolling
    df = spark.createDataFrame([("u", 1, 9), ("u", 2, None), ("u", 3, 8), ("u", 4, 15)], "k STRING, o INT, v BIGINT")
    out = rolling.previous_jump(df, ["k"], ["o"], "v")
    assert rows(out, "o", "last_value") == [(1, 0), (4, 8)]


@pytest.mark.parametrize("ranges", [1, 4])
@pytest.mark.parametrize("sep", ["", ", "])
def test_concats_with_null_tokens(spark, ranges, sep):
    from eventide.operators import rolling
    data = [("x", i, None if i % 4 == 1 else chr(97 + i) * (i % 3)) for i in range(12)] + [("y", 1, None)]
    df = spark.createDataFrame(data, "k STRING, o INT, t STRING")
    d = deal(df, ["k"], ["o"], ranges)
    text = lambda items: sep.join(t for t in items if t is not None)
    got = {(r.k, r.o): r.text for r in rolling.running_concat(d, ["k"], ["o"], "t", sep=sep).collect()}
    for k, o, _t in data:
        assert got[(k, o)] == text([t for kk, oo, t in data if kk == k and oo <= o]), (k, o)
    if sep == "":
        final = {r.k: r.text for r in rolling.ordered_concat(d, ["k"], ["o"], "t").collect()}
        assert final == {k: text([t for kk, _o, t in data if kk == k]) for k in ("x", "y")}


def test_strict_checks_survive_count_and_pruning(spark):
    from eventide.operators import joins
    df = spark.createDataFrame([(1, "a"), (2, "zzz")], "id INT, kind STRING")
    good = quality.check_domain(df, "kind", ["a", "zzz"])
    assert good.count() == 2 and rows(good, "id") == [(1,), (2,)]
    for broken in (quality.check_domain(df, "kind", ["a"]),
                   quality.check_domain(df.withColumn("kind", F.when(F.col("id") == 1, "a")), "kind", ["a"]),
                   joins.require_orders(df.withColumn("status", F.lit("orphan")))):
        for action in (lambda d: d.count(), lambda d: d.select("id").collect()):
            with pytest.raises(Exception):
                action(broken)


def test_weights_with_missing_section_or_value_fail(spark, tmp_path):
    from eventide.sources.files import read_weights
    item = '[{"name": "A", "probability": 1.0}]'
    docs = {"ok": f'{{"stores": {item}, "appIds": {item}, "eventTypes": {item}, "eventTimeFreqMillis": 5}}',
            "section": f'{{"stores": {item}, "eventTypes": {item}}}',
            "value": f'{{"stores": {item}, "appIds": [{{"name": "B"}}], "eventTypes": {item}}}'}
    for name, text in docs.items():
        (tmp_path / name).write_text(text)
        if name == "ok":
            assert read_weights(spark, str(tmp_path / name)).count() == 3
        else:
            with pytest.raises(Exception):
                read_weights(spark, str(tmp_path / name)).count()


def test_weighted_draw_on_interval_bounds(spark):
    """Values of p within a few ulps of every bound: one row each, none lost."""
    import math
    from eventide.operators import weights
    for parts in ([.1, .2, .3, .4], [1 / 7] * 7, [.25] * 4, [0.0, 1.0]):
        table = spark.createDataFrame([("d", i, f"n{i}", w) for i, w in enumerate(parts)],
                                      "dimension STRING, pos INT, name STRING, probability DOUBLE")
        sums = [sum(parts[:i + 1]) for i in range(len(parts))]
        ps = {0.0, 1.0}
        for s_ in sums:
            x = s_
            for _ in range(3):
                ps |= {min(x, 1.0), min(max(2 * s_ - x, 0.0), 1.0)}
                x = math.nextafter(x, 2)
        df = spark.createDataFrame([(p,) for p in sorted(ps)] + [(None,)], "p DOUBLE")
        got = weights.assign(df, "p", table, "d", "item").collect()
        assert len(got) == len(ps) + 1
        running = []
        for w in parts:
            running.append((running[-1] if running else 0.0) + w)
        running[-1] = 1.0
        for r in got:
            assert r["item"] == (None if r["p"] is None else f"n{next(i for i, h in enumerate(running) if r['p'] <= h)}")
    bad = spark.createDataFrame([("d", 0, "a", .5), ("d", 1, "b", .4)],
                                "dimension STRING, pos INT, name STRING, probability DOUBLE")
    with pytest.raises(Exception):
        weights.assign(df, "p", bad, "d", "item").count()


def test_print_rows_prints_every_row(spark, capsys):
    from eventide.sources.sinks import print_rows
    print_rows(spark.range(57))
    assert sorted(capsys.readouterr().out.split()) == sorted(f"id={i}" for i in range(57))


def test_csv_parts_in_name_order_are_sorted(spark, tmp_path):
    """K-3 / SNK-2: part files read in name order are one sorted file."""
    from eventide.sources.files import write_sorted_csv
    rnd = random.Random(4)
    df = spark.createDataFrame([(rnd.randint(0, 999), i) for i in range(400)], "t INT, id INT").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted_csv(df, str(tmp_path / "out"), ["t", "id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lines = [tuple(map(int, line.split(","))) for part in sorted((tmp_path / "out").glob("part-*"))
             for line in part.read_text().splitlines()]
    assert len(lines) == 400 and lines == sorted(lines)
    assert len(list((tmp_path / "out").glob("part-*"))) > 1


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_run_ids_match_python(spark, width):
    from eventide.operators.scan import run_ids
    rnd = random.Random(width)
    data = [(k, i, rnd.choice(["x", "y", None]) if rnd.random() < 0.3 else "x")
            for k in ("a", "b") for i in range(0, 200, rnd.choice([1, 2, 3]))]
    df = spark.createDataFrame(data, "k STRING, o INT, v STRING")
    got = {(r.k, r.o): r.run_id for r in
           run_ids(df, ["k"], ["o"], F.col("v"), value_chunk("o", width)).collect()}
    for key in ("a", "b"):
        run, prev = 0, object()
        for k, o, v in data:
            if k != key:
                continue
            run += v != prev
            prev = v
            assert got[(k, o)] == run, (k, o)


def test_results_independent_of_row_order_and_partitions(spark):
    """SURVEY §5.5: same result for shuffled input and any partition count."""
    from eventide.plans import jobs
    rnd = random.Random(9)
    data = [(rnd.choice(["S1", "S2"]), rnd.choice("ABC"),
             rnd.choice(["install", "uninstall", "page_view", "error"]), at(i * 700), i)
            for i in range(400)]
    schema = "store STRING, app_id STRING, event_type STRING, event_time TIMESTAMP, ord INT"
    results = []
    for parts, seed in ((1, 0), (7, 1), (3, 2)):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, schema).repartition(parts)
        top, errors = jobs.store_reports(df, 9, 5)
        clicks = df.select(F.col("store").alias("user_id"), F.col("event_time").alias("click_time"))
        results.append((rows(top, "store", "batch_no", "kind", "rank", "app_id", "n"),
                        rows(errors, "window_start_ms", "report"),
                        rows(jobs.click_sessions(clicks, gap_ms=600), "session_start_ms", "clicks"),
                        rows(jobs.busiest_window(clicks), "w_start_ms", "click_count")))
    assert results[0] == results[1] == results[2]


def test_open_batch_reported_on_request(spark):
    kinds = ["install", "install", "install", "uninstall", "install"]
    df = spark.createDataFrame([("s", i, k) for i, k in enumerate(kinds)],
                               "store STRING, ord INT, event_type STRING")
    tagged = segments.assign_batches(df, "store", ["ord"], "event_type", install_threshold=3,
                                     uninstall_threshold=5)
    assert segments.app_counts(tagged, "store", "event_type").select("batch_no").distinct().count() == 1
    open_too = segments.app_counts(tagged, "store", "event_type", keep_open=True)
    assert rows(open_too.groupBy("batch_no").agg(F.sum("installs").alias("i")), "batch_no", "i") == [
        (1, 3), (2, 1)]


def test_missing_value_text_and_map_report(spark):
    from eventide.functions.render import min_max_line, or_missing
    from eventide.operators.windows import counts_per_window_report
    df = spark.createDataFrame([(None,), (5,)], "v BIGINT")
    assert sorted(r[0] for r in df.select(or_missing("v")).collect()) == ["5", "No bookings"]
    line = spark.range(1).select(min_max_line(F.lit("X"), F.lit(0), F.lit(2000),
                                              F.lit(None).cast("long"), F.lit(3))).first()[0]
    assert line == "Window [0 - 2000] Type X bookings count: Min=No bookings Max=3."
    counts = spark.createDataFrame([(0, 10, "S2", 4), (0, 10, "S1", 2), (10, 20, "S1", 1)],
                                   "window_start_ms BIGINT, window_end_ms BIGINT, store STRING, n BIGINT")
    rep = {r.window_start_ms: r for r in counts_per_window_report(counts, "store", as_map=True).collect()}
    assert rep[0].report == "ERROR RATE Store: S1 Error count: 2 Store: S2 Error count: 4"
    assert rep[0].counts == {"S1": 2, "S2": 4} and rep[0].n_total == 6 and rep[10].n_keys == 1


def test_top_k_ties_break_by_name(spark):
    counts = spark.createDataFrame(
        [("s", 1, "C", 2, 0), ("s", 1, "A", 2, 0), ("s", 1, "B", 2, 1), ("s", 1, "D", 1, 1)],
        "store STRING, batch_no BIGINT, app STRING, installs BIGINT, uninstalls BIGINT")
    top = segments.top_apps(counts, "store", "app", top_n=2)
    assert rows(top, "kind", "rank", "app", "n") == [
        ("install", 1, "A", 2), ("install", 2, "B", 2),
        ("uninstall", 1, "B", 1), ("uninstall", 2, "D", 1)]


def test_earliest_time_per_window(spark):
    from eventide.operators.windows import window_min_time
    df = spark.createDataFrame([("a", at(1500)), ("a", at(900)), ("b", at(2500)), ("a", at(2600))], "k STRING, t TIMESTAMP")
    out = window_min_time(df, "t", 2000, keys=["k"]).select("k", F.unix_millis("min_time").alias("ms"), "n")
    assert rows(out, "k", "ms", "n") == [("a", T0_MS + 900, 2), ("a", T0_MS + 2600, 1), ("b", T0_MS + 2500, 1)]
