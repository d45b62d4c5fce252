"""Golden results of FIXTURES.md through the public jobs (one per query)."""

from pyspark.sql import functions as F

from helpers import T0_MS, at, rows
from eventide.plans import jobs
from eventide.sources.inline import from_rows

TEXTS = [
    ("The harbour opens early, and boats leave for The islands before noon.",),
    ("This ferry carries mail, bread and bicycles.",),
    ("Lighthouse lamps now burn on electric power,",),
    ("giving the keepers a quieter night than their fathers knew.",),
]


def test_f1_article_counts(spark):
    df = from_rows(spark, TEXTS, "text STRING")
    assert rows(jobs.article_counts(df), "token", "count") == [("a", 1), ("the", 3)]
    run = jobs.article_counts(df, running=True).orderBy("ord", "pos")
    assert [(r.token, r["count"]) for r in run.collect()] == [
        ("the", 1), ("the", 2), ("the", 3), ("a", 1)]


def test_f2_language_concat(spark):
    df = from_rows(spark, [("en", "car, bus, "), ("ru", "машина, "), ("en", "course, "),
                           ("en", "house, ")], "language STRING, token STRING")
    assert rows(jobs.language_concat(df), "language", "text") == [
        ("en", "car, bus, course, house, "), ("ru", "машина, ")]
    assert rows(jobs.language_concat(df, running=True), "ord", "language", "text") == [
        (0, "en", "car, bus, "), (1, "ru", "машина, "), (2, "en", "car, bus, course, "),
        (3, "en", "car, bus, course, house, ")]


# fixed values
CLICKS_F3 = [("550e8400", 1000), ("550e6200", 1000), ("550e1207", 1000), ("550e8400", 2000),
             ("550e6200", 2000), ("550e1207", 3000), ("550e8400", 4000), ("550e1207", 4000),
             ("550e6200", 4000), ("550e1207", 8000), ("550e6200", 8000), ("550e1207", 9000),
             ("550e1207", 10000), ("550e1207", 11000), ("550e6200", 11000), ("550e1207", 12000),
             ("550e8400", 12000), ("550e1207", 18000)]


def _clicks(spark, data):
    return spark.createDataFrame([(u, at(ms)) for u, ms in data], "user_id STRING, click_time TIMESTAMP")


def test_f3_click_sessions(spark):
    out = rows(jobs.click_sessions(_clicks(spark, CLICKS_F3)),
               "session_start_ms", "session_end_ms", "clicks")
    assert [(s - T0_MS, e - T0_MS, n) for s, e, n in out] == [
        (1000, 7000, 9), (8000, 15000, 8), (18000, 21000, 1)]
    lines = [r.line for r in jobs.click_sessions(_clicks(spark, CLICKS_F3), with_line=True)
             .orderBy("session_start_ms").collect()]
    assert lines[0] == f"Window [{T0_MS + 1000} - {T0_MS + 7000}] click count: 9"


def test_f3_session_gap_boundary(spark):
    data = [("u", 1000), ("u", 4000), ("u", 7000), ("u", 10001)]
    out = rows(jobs.click_sessions(_clicks(spark, data)), "session_start_ms", "session_end_ms", "clicks")
    assert [(s - T0_MS, e - T0_MS, n) for s, e, n in out] == [(1000, 10000, 3), (10001, 13001, 1)]


# fixed values
BOOKINGS = [("Domestic", 1000, 4), ("International", 1000, 6), ("Domestic", 1000, 10),
            ("International", 1200, 7), ("International", 1800, 12), ("International", 1500, 4),
            ("International", 2000, 1), ("Domestic", 2100, 0), ("Domestic", 3000, 2),
            ("International", 6000, 8), ("International", 6000, 1), ("Domestic", 6700, 1),
            ("International", 7200, 5), ("Domestic", 8000, 3), ("International", 8100, 6),
            ("Domestic", 8400, 14), ("International", 9000, 2), ("International", 9000, 4)]


def test_f4_booking_min_max(spark):
    df = spark.createDataFrame([(g, at(ms), n) for g, ms, n in BOOKINGS],
                               "geo_region STRING, event_time TIMESTAMP, booking_count BIGINT")
    out = jobs.booking_min_max(df, with_line=True)
    got = [(g, s - T0_MS, e - T0_MS, lo, hi) for g, s, e, lo, hi in
           rows(out, "geo_region", "window_start_ms", "window_end_ms", "min_value", "max_value")]
    dom = [(0, 2000, 4, 10), (1000, 3000, 0, 10), (2000, 4000, 0, 2), (3000, 5000, 2, 2),
           (5000, 7000, 1, 1), (6000, 8000, 1, 1), (7000, 9000, 3, 14), (8000, 10000, 3, 14)]
    intl = [(0, 2000, 4, 12), (1000, 3000, 1, 12), (2000, 4000, 1, 1), (5000, 7000, 1, 8),
            (6000, 8000, 1, 8), (7000, 9000, 5, 6), (8000, 10000, 2, 6), (9000, 11000, 2, 4)]
    assert got == [("Domestic", *r) for r in dom] + [("International", *r) for r in intl]
    line = out.filter("geo_region = 'Domestic' AND min_value = 0").orderBy("window_start_ms").first().line
    assert line == (f"Window [{T0_MS + 1000} - {T0_MS + 3000}] Type Domestic bookings count: "
                    "Min=0 Max=10.")


def test_f5_click_jumps(spark):
    data = [("u1", 0, 6), ("u1", 1, 6), ("u1", 2, 0), ("u1", 3, 5), ("u1", 4, 9),
            ("u2", 0, 5), ("u2", 1, 0), ("u2", 2, 6), ("u3", 0, 0)]
    df = from_rows(spark, [(u, "b", c, at(s * 1000)) for u, s, c in data],
                   "user_id STRING, button STRING, click_count BIGINT, time TIMESTAMP")
    out = jobs.click_jumps(df).select("user_id", F.unix_millis("time").alias("ms"),
                                      "click_count", "last_clicks_count")
    assert [(u, (ms - T0_MS) // 1000, c, last) for u, ms, c, last in
            rows(out, "user_id", "ms", "click_count", "last_clicks_count")] == [
        ("u1", 0, 6, 0), ("u1", 2, 0, 6), ("u2", 1, 0, 5), ("u2", 2, 6, 0), ("u3", 0, 0, 0)]


def test_f6_store_batches(spark):
    data = [("A", "install"), ("B", "install"), ("A", "page_view"), ("A", "install"),
            ("B", "uninstall"), ("A", "install"), ("B", "uninstall"), ("A", "install"),
            ("C", "install"), ("A", "error")]
    df = from_rows(spark, [("S1", app, t, at(i * 1000)) for i, (app, t) in enumerate(data)],
                   "store STRING, app_id STRING, event_type STRING, event_time TIMESTAMP")
    top, errors = jobs.store_reports(df, install_threshold=3, uninstall_threshold=2)
    assert rows(top, "batch_no", "kind", "rank", "app_id", "n") == [
        (1, "install", 1, "A", 2), (1, "install", 2, "B", 1),
        (2, "install", 1, "A", 1), (2, "uninstall", 1, "B", 2)]
    rep = errors.collect()
    assert len(rep) == 1 and rep[0].report == "ERROR RATE Store: S1 Error count: 1"


def test_f8_acronym_periods(spark):
    data = [("a", 14390000), ("b", 14391000), ("a", 14399000), ("c", 14400000),
            ("c", 14401000), ("a", 43200000), ("b", 104400000)]
    df = spark.createDataFrame([(str(i), ms, "u", "hw", a) for i, (a, ms) in enumerate(data)],
                               "commentId STRING, time BIGINT, user STRING, topic STRING, acronim STRING")
    out = jobs.acronym_periods(df)
    got = rows(out, "closed_at_ms", "acronym", "acronyms_counter", "total_comments_counter",
               "period_time_of_day", "label_time_of_day")
    assert [(c - T0_MS, *r) for c, *r in got] == [
        (14400000, "a", 2, 3, "Midnight", "Mourning"), (14400000, "b", 1, 3, "Midnight", "Mourning"),
        (43200000, "c", 2, 2, "Mourning", "Day"), (104400000, "a", 1, 1, "Day", "Mourning")]
    old = jobs.acronym_periods(df, with_label=False)
    assert "label_time_of_day" not in old.columns and old.count() == 4


# fixed values
CLICKS_F9 = [("550e8400", 1000), ("550e6200", 1000), ("550e1207", 1000), ("550e8400", 2000),
             ("550e8400", 3000), ("550e1207", 3000), ("550e8400", 4000), ("550e1207", 4000),
             ("550e6200", 5000), ("550e1207", 6000), ("550e6200", 6000), ("550e1207", 7000),
             ("550e1207", 8000), ("550e1207", 9000), ("550e6200", 10000), ("550e1207", 11000),
             ("550e8400", 12000), ("550e1207", 12000)]


def test_f9_busiest_window(spark):
    from eventide.operators.windows import window_counts
    df = _clicks(spark, CLICKS_F9)
    counts = window_counts(df, "click_time", 2000, slide_ms=1000)
    assert [n for _s, n in rows(counts, "window_start_ms", "n")] == [3, 4, 3, 4, 3, 3, 3, 2, 2, 2, 2, 3, 2]
    assert rows(jobs.busiest_window(df), "w_start_ms", "w_end_ms", "click_count") == [
        (1689379201000, 1689379203000, 4)]


# fixed values
ORDERS = [("675e3421", "2023-06-15T12:07:13.000Z"), ("267e9361", "2023-06-19T23:15:44.000Z"),
          ("267e8761", "2023-06-03T14:35:05.000Z"), ("267e9061", "2023-07-01T00:18:34.000Z"),
          ("452e7169", "2023-06-30T13:55:21.000Z")]
DELIVERIES = [("d923e0511", "675e3421", "2023-06-16T14:11:54.000Z"),
              ("d876e0521", "267e9361", "2023-06-25T18:04:40.000Z"),
              ("d653e1241", "267e8761", "2023-06-05T17:17:36.000Z"),
              ("d923e0511", "267e9061", "2023-07-04T02:18:34.000Z"),
              ("d745e1941", "452e7169", "2023-06-02T03:42:11.000Z")]


def test_f10_delivery_report(spark):
    o = spark.createDataFrame(ORDERS, "id STRING, order_time STRING")
    d = spark.createDataFrame(DELIVERIES, "id STRING, order_id STRING, delivery_time STRING")
    classified, summary = jobs.delivery_report(o, d)
    got = rows(classified, "order_id", "lateness_us", "status")
    assert sorted((oid, us // 1_000_000, st) for oid, us, st in got) == sorted([
        ("675e3421", 93881, "in_time"), ("267e9361", 499736, "late"), ("267e8761", 182551, "in_time"),
        ("267e9061", 266400, "late"), ("452e7169", -2455990, "before_order")])
    s = summary.first()
    assert (s.in_time, s.late, s.before_order, s.orphan) == (2, 2, 1, 0)
