"""Registered queries over the driver's tables, each with its DuckDB oracle.

Each entry binds one reference job (or one of its operators) to the test
tables, runs over the whole tables, and names every output column the same
way in Spark and in SQL. Window bounds and instants are epoch-ms BIGINT
(DuckDB: ``epoch_us(ts) // 1000``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.constants import ARTICLES, STORE_EVENT_TYPES, T0_MS
from eventide.functions.predicates import null_safe_not
from eventide.functions.text import explode_tokens
from eventide.functions.timefn import epoch_ms, parse_instant, rebase_ms
from eventide.operators import (joins, periods, quality, rolling, segments, sessions,
                                weights, windows)
from eventide.sources import files
from eventide.operators.scan import CHUNK, deal
from eventide.sources.tables import events, table
from eventide.session import materialize, scratch_path, use_utc
from eventide.streaming.replay import late_sql

HOUR_MS = 3_600_000


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def register(name: str, ops: str, sql: str | None):
    def wrap(fn):
        REGISTRY[name] = Query(name, fn, sql, ops)
        return fn
    return wrap


# ---------------------------------------------------------------- Q1 articles
@register("article_counts", "P-1 P-2 P-3 AGG-1 F-1 F-2", """
SELECT tok AS token, count(*) AS n
FROM (SELECT unnest(string_split_regex(lower(text), '\\W+')) AS tok FROM documents)
WHERE tok IN ('the', 'a')
GROUP BY tok
""")
def article_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "text")
    toks = explode_tokens(docs, "text", keep=ARTICLES)
    return rolling.final_counts(toks, ["token"])


@register("article_running", "P-1 P-2 AGG-1 W-6", """
WITH t AS (
  SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos
  FROM (SELECT doc_id, string_split_regex(lower(text), '\\W+') AS l FROM documents))
SELECT doc_id, pos, token,
       count(*) OVER (PARTITION BY token ORDER BY doc_id, pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_count
FROM t WHERE token IN ('the', 'a')
""")
def article_running(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    # split the whole texts once; the kept tokens are read twice below
    toks = materialize(explode_tokens(docs, "text", keep=ARTICLES, pos_col="pos"), "article-tokens")
    return rolling.running_counts(toks, ["token"], ["doc_id", "pos"])


# -------------------------------------------------------------- Q2 concat
@register("concat_per_key", "AGG-2 F-3 P-4", """
SELECT o_custkey, string_agg(o_orderpriority || ', ', '' ORDER BY o_orderkey) AS text
FROM orders GROUP BY o_custkey
""")
def concat_per_key(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority")
    o = o.withColumn("token", F.concat("o_orderpriority", F.lit(", ")))
    return rolling.ordered_concat(o, ["o_custkey"], ["o_orderkey"], "token")


@register("concat_running", "AGG-2 W-6 F-3", """
SELECT o_custkey, o_orderkey,
       string_agg(o_orderpriority || ', ', '') OVER (
         PARTITION BY o_custkey ORDER BY o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS text
FROM orders
""")
def concat_running(spark, sf_dir):
    o = table(spark, sf_dir, "orders", "o_custkey", "o_orderkey", "o_orderpriority")
    o = o.withColumn("token", F.concat("o_orderpriority", F.lit(", ")))
    out = rolling.running_concat(o, ["o_custkey"], ["o_orderkey"], "token")
    return out.select("o_custkey", "o_orderkey", "text")


# ----------------------------------------------------------- Q3 sessions
@register("click_sessions", "S-6 AGG-3 S-3", """
WITH t AS (SELECT epoch_us(ts) AS us FROM events),
f AS (SELECT us, CASE WHEN us - lag(us) OVER (ORDER BY us) <= 600000000 THEN 0 ELSE 1 END AS s FROM t),
g AS (SELECT us, sum(s) OVER (ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f)
SELECT min(us) // 1000 AS session_start_ms, (max(us) + 600000000) // 1000 AS session_end_ms,
       count(*) AS clicks
FROM g GROUP BY sid
""")
def click_sessions(spark, sf_dir):
    ev = events(spark, sf_dir, "ts")
    return sessions.global_sessions(ev, "ts", 10 * 60 * 1000, count_name="clicks")


# ---------------------------------------------------------- Q4 min / max
@register("sliding_min_max", "S-5 AGG-4 F-8", """
WITH w AS (
  SELECT event_type, value, (epoch_us(ts) // 3600000000 - k) * 3600000000 AS ws
  FROM events, (VALUES (0), (1)) AS s(k))
SELECT event_type, ws // 1000 AS window_start_ms, (ws + 7200000000) // 1000 AS window_end_ms,
       min(value) AS min_value, max(value) AS max_value, count(*) AS n
FROM w GROUP BY event_type, ws
""")
def sliding_min_max(spark, sf_dir):
    ev = events(spark, sf_dir, "ts", "event_type", "value")
    return windows.window_min_max(ev, "ts", "value", 2 * HOUR_MS, keys=["event_type"],
                                  slide_ms=HOUR_MS)


# ------------------------------------------------------------ Q5 jumps
@register("previous_jump", "W-1 P-10", """
WITH c AS (SELECT user_id, event_id, ts, CAST(floor(value) AS BIGINT) % 10 AS click_count FROM events),
l AS (SELECT *, lag(click_count, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_click_count FROM c)
SELECT user_id, event_id, epoch_us(ts) // 1000 AS ts_ms, click_count, last_click_count
FROM l WHERE click_count = 0 OR click_count - last_click_count > 5
""")
def previous_jump(spark, sf_dir):
    ev = events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    ev = ev.withColumn("click_count", F.floor("value").cast("long") % 10)
    out = rolling.previous_jump(ev, ["user_id"], ["ts", "event_id"], "click_count",
                                last_name="last_click_count")
    return out.select("user_id", "event_id", epoch_ms("ts").alias("ts_ms"),
                      "click_count", "last_click_count")


@register("previous_jump_chunked", "W-1 P-10 over many ranges", REGISTRY["previous_jump"].sql)
def previous_jump_chunked(spark, sf_dir):
    """``previous_jump`` over 512 small ranges, so that many users span
    ranges and the previous value is carried across their borders; same result and oracle as
    ``previous_jump``."""
    ev = events(spark, sf_dir, "user_id", "event_id", "ts", "value")
    ev = ev.withColumn("click_count", F.floor("value").cast("long") % 10)
    ev = deal(ev, ["user_id"], ["ts", "event_id"], ranges=512)
    out = rolling.previous_jump(ev, ["user_id"], ["ts", "event_id"], "click_count",
                                last_name="last_click_count").drop(CHUNK)
    return out.select("user_id", "event_id", epoch_ms("ts").alias("ts_ms"),
                      "click_count", "last_click_count")


# ------------------------------------------------------------- side output
_SPLIT_COLS = "event_id, epoch_us(ts) // 1000 AS ts_ms, user_id, event_type, value"


def _split(spark, sf_dir, side: bool):
    ev = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value")
    pred = F.col("event_type") == F.lit("error")
    part = ev.filter(pred) if side else ev.filter(null_safe_not(pred))
    return part.select("event_id", epoch_ms("ts").alias("ts_ms"), "user_id", "event_type", "value")


@register("split_side", "P-6", f"SELECT {_SPLIT_COLS} FROM events WHERE event_type = 'error'")
def split_side(spark, sf_dir):
    return _split(spark, sf_dir, side=True)


@register("split_main", "P-6",
          f"SELECT {_SPLIT_COLS} FROM events WHERE coalesce(event_type = 'error', false) = false")
def split_main(spark, sf_dir):
    return _split(spark, sf_dir, side=False)


# ------------------------------------------------------------ Q7 errors
_ERRORS_SQL = """
WITH e AS (SELECT user_id % 4 AS store, epoch_us(ts) // 86400000000 * 86400000 AS ws
           FROM events WHERE event_type = 'error'),
c AS (SELECT ws AS window_start_ms, ws + 86400000 AS window_end_ms, store, count(*) AS n_errors
      FROM e GROUP BY ws, store)
"""


def _errors_per_window(spark, sf_dir):
    ev = events(spark, sf_dir, "ts", "user_id", "event_type")
    err = ev.filter(F.col("event_type") == "error").withColumn("store", F.col("user_id") % 4)
    return windows.window_counts(err, "ts", 24 * HOUR_MS, keys=["store"], name="n_errors")


@register("errors_per_window", "S-4 AGG-5 P-6", _ERRORS_SQL + "SELECT * FROM c")
def errors_per_window(spark, sf_dir):
    return _errors_per_window(spark, sf_dir).select(
        "window_start_ms", "window_end_ms", "store", "n_errors")


@register("errors_report", "AGG-6 F-10", _ERRORS_SQL + """
SELECT window_start_ms, window_end_ms, count(*) AS n_keys, CAST(sum(n_errors) AS BIGINT) AS n_total,
       'ERROR RATE ' || string_agg('Store: ' || store || ' Error count: ' || n_errors, ' ' ORDER BY store) AS report
FROM c GROUP BY window_start_ms, window_end_ms
""")
def errors_report(spark, sf_dir):
    return windows.counts_per_window_report(_errors_per_window(spark, sf_dir), "store", "n_errors")


# ------------------------------------------------------- Q9 busiest window
@register("busiest_window", "S-5 S-7 S-15 AGG-3 AGG-7", """
WITH w AS (
  SELECT (epoch_us(ts) // 3600000000 - k) * 3600000000 AS ws
  FROM events, (VALUES (0), (1)) AS s(k)),
c AS (SELECT ws, count(*) AS click_count, ws + 7200000000 - 1 AS wt FROM w GROUP BY ws),
f AS (SELECT *, CASE WHEN wt - lag(wt) OVER (ORDER BY wt) <= 10800000000 THEN 0 ELSE 1 END AS s FROM c),
g AS (SELECT *, sum(s) OVER (ORDER BY wt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY click_count DESC, ws) AS rk FROM g)
SELECT ws // 1000 AS w_start_ms, (ws + 7200000000) // 1000 AS w_end_ms, click_count FROM r WHERE rk = 1
""")
def busiest_window(spark, sf_dir):
    ev = events(spark, sf_dir, "ts")
    return sessions.busiest_window(ev, "ts", 2 * HOUR_MS, HOUR_MS, 3 * HOUR_MS)


# --------------------------------------------------- store-event binding
# events as the store stream: store = user_id % 4, app = props.k,
# signup -> install, purchase -> uninstall, view -> page_view.
_STORE_KIND_SQL = ("CASE event_type WHEN 'signup' THEN 'install' WHEN 'purchase' THEN 'uninstall' "
                   "WHEN 'view' THEN 'page_view' ELSE event_type END")


def _store_events(spark, sf_dir):
    ev = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    kind = (F.when(F.col("event_type") == "signup", "install")
            .when(F.col("event_type") == "purchase", "uninstall")
            .when(F.col("event_type") == "view", "page_view")
            .otherwise(F.col("event_type")))
    return ev.select("event_id", "ts", (F.col("user_id") % 4).alias("store"),
                     F.get_json_object("props", "$.k").alias("app"), kind.alias("kind"))


def _batches(spark, sf_dir):
    main, _side = quality.split(_store_events(spark, sf_dir), F.col("kind") == "error")
    return segments.assign_batches(main, "store", ["ts", "event_id"], "kind")


_THRESH_CTE = """
WITH RECURSIVE
ev AS (SELECT user_id % 4 AS store, event_id, ts, event_type,
              json_extract_string(props, '$.k') AS app,
              CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS is_i,
              CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_u
       FROM events WHERE coalesce(event_type = 'error', false) = false),
sc AS (SELECT *, row_number() OVER (PARTITION BY store ORDER BY ts, event_id) AS rn,
              sum(is_i) OVER w AS ci, sum(is_u) OVER w AS cu
       FROM ev WINDOW w AS (PARTITION BY store ORDER BY ts, event_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
inst AS (SELECT store, ci AS c, rn FROM sc WHERE is_i = 1),
unin AS (SELECT store, cu AS c, rn FROM sc WHERE is_u = 1),
cand AS (SELECT store, rn, ci, cu FROM sc WHERE is_i = 1 OR is_u = 1
         UNION ALL SELECT DISTINCT store, 0, 0, 0 FROM sc),
nxt AS (SELECT a.store, a.rn, least(i.rn, u.rn) AS to_rn FROM cand a
        LEFT JOIN inst i ON i.store = a.store AND i.c = a.ci + 100
        LEFT JOIN unin u ON u.store = a.store AND u.c = a.cu + 50),
walk(store, rn, batch_no) AS (
  SELECT DISTINCT store, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM sc
  UNION ALL
  SELECT n.store, n.to_rn, w.batch_no + 1 FROM walk w
  JOIN nxt n ON n.store = w.store AND n.rn = w.rn WHERE n.to_rn IS NOT NULL),
b AS (SELECT store, batch_no, rn AS close_rn,
             lag(rn) OVER (PARTITION BY store ORDER BY rn) AS open_rn FROM walk),
tagged AS (SELECT s.*, b.batch_no, b.close_rn FROM sc s JOIN b
           ON s.store = b.store AND b.batch_no > 0 AND s.rn > b.open_rn AND s.rn <= b.close_rn),
apps AS (SELECT store, batch_no, app, CAST(sum(is_i) AS BIGINT) AS installs,
                CAST(sum(is_u) AS BIGINT) AS uninstalls FROM tagged GROUP BY store, batch_no, app),
kinds AS (SELECT store, batch_no, app, 'install' AS kind, installs AS n FROM apps WHERE installs > 0
          UNION ALL
          SELECT store, batch_no, app, 'uninstall' AS kind, uninstalls AS n FROM apps WHERE uninstalls > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY store, batch_no, kind ORDER BY n DESC, app) AS rank
           FROM kinds),
top AS (SELECT * FROM ranked WHERE rank <= 3)
"""


@register("threshold_batches", "W-2 S-9 P-6 P-9 U-6", _THRESH_CTE + """
SELECT store, batch_no, count(*) AS n_rows, CAST(sum(is_i) AS BIGINT) AS installs,
       CAST(sum(is_u) AS BIGINT) AS uninstalls, max(close_rn) AS close_rn,
       max(CASE WHEN rn = close_rn THEN epoch_us(ts) // 1000 END) AS close_ts_ms,
       max(CASE WHEN rn = close_rn THEN event_id END) AS close_id
FROM tagged GROUP BY store, batch_no
""")
def threshold_batches(spark, sf_dir):
    summary = segments.batch_summary(_batches(spark, sf_dir), "store", "ts", "event_id")
    return summary.drop("closed")


@register("threshold_batches_doubling", "W-2 over many ranges", REGISTRY["threshold_batches"].sql)
def threshold_batches_doubling(spark, sf_dir):
    """``threshold_batches`` over 96 small ranges: every store lies in many chunks
    and their exits are chained over two levels; same result and oracle."""
    main, _side = quality.split(_store_events(spark, sf_dir), F.col("kind") == "error")
    tagged = segments.assign_batches(main, "store", ["ts", "event_id"], "kind", ranges=96)
    return segments.batch_summary(tagged, "store", "ts", "event_id").drop("closed")


@register("threshold_top_apps", "W-2 AGG-13 K-1", _THRESH_CTE + """
SELECT store, batch_no, kind, rank, app, n FROM top
""")
def threshold_top_apps(spark, sf_dir):
    counts = segments.app_counts(_batches(spark, sf_dir), "store", "app")
    return segments.top_apps(counts, "store", "app").select(
        "store", "batch_no", "kind", F.col("rank").cast("long").alias("rank"), "app", "n")


@register("threshold_report", "W-2 AGG-13 K-1 F-10", _THRESH_CTE + """
SELECT store, batch_no,
  'INSTALL/UNINSTALL Store: ' || store
  || ' Top ' || count(*) FILTER (WHERE kind = 'install') || ' installed: '
  || coalesce(string_agg(app || ' (' || n || ')', ', ' ORDER BY rank) FILTER (WHERE kind = 'install'), '')
  || ' Top ' || count(*) FILTER (WHERE kind = 'uninstall') || ' uninstalled: '
  || coalesce(string_agg(app || ' (' || n || ')', ', ' ORDER BY rank) FILTER (WHERE kind = 'uninstall'), '')
  || ' ' AS report
FROM top GROUP BY store, batch_no
""")
def threshold_report(spark, sf_dir):
    counts = segments.app_counts(_batches(spark, sf_dir), "store", "app")
    return segments.top_apps_report(segments.top_apps(counts, "store", "app"), "store", "app")


@register("type_quarantine", "P-8 VAL-3", f"""
SELECT event_id, {_STORE_KIND_SQL} AS kind FROM events
WHERE coalesce(({_STORE_KIND_SQL}) IN ('install', 'uninstall', 'page_view', 'error'), false) = false
""")
def type_quarantine(spark, sf_dir):
    _good, bad = quality.quarantine_domain(_store_events(spark, sf_dir), "kind", STORE_EVENT_TYPES)
    return bad.select("event_id", "kind")


# ------------------------------------------------------ Q8 periods
@register("period_top_tokens", "S-4 F-9 W-3 W-4 W-5 AGG-11 AGG-12 K-2", """
WITH c AS (SELECT event_type AS topic, json_extract_string(props, '$.k') AS acronym,
                  epoch_us(ts) // 10000000 AS w, epoch_us(ts) AS us FROM events),
win AS (SELECT topic, w, min(us) AS min_us, count(*) AS total FROM c GROUP BY topic, w),
lab AS (SELECT *, CASE WHEN (min_us // 3600000000) % 24 >= 4 AND (min_us // 3600000000) % 24 < 12 THEN 'Mourning'
                       WHEN (min_us // 3600000000) % 24 >= 12 AND (min_us // 3600000000) % 24 < 17 THEN 'Day'
                       WHEN (min_us // 3600000000) % 24 >= 17 THEN 'Evening'
                       ELSE 'Midnight' END AS label FROM win),
fl AS (SELECT *, CASE WHEN lag(label) OVER (PARTITION BY topic ORDER BY w) = label THEN 0 ELSE 1 END AS f
       FROM lab),
isl AS (SELECT *, sum(f) OVER (PARTITION BY topic ORDER BY w
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS period FROM fl),
per AS (SELECT topic, period, any_value(label) AS label, min(min_us) AS first_us, sum(total) AS total
        FROM isl GROUP BY topic, period),
fin AS (SELECT p.topic, p.period, p.label, p.total, n.label AS next_label, n.first_us AS next_us
        FROM per p JOIN per n ON n.topic = p.topic AND n.period = p.period + 1),
acr AS (SELECT i.topic, i.period, c.acronym, count(*) AS cnt FROM c
        JOIN isl i ON i.topic = c.topic AND i.w = c.w GROUP BY i.topic, i.period, c.acronym),
top AS (SELECT *, row_number() OVER (PARTITION BY topic, period ORDER BY cnt DESC, acronym) AS rk FROM acr)
SELECT t.topic, t.acronym, t.cnt AS acronyms_counter, CAST(f.total AS BIGINT) AS total_comments_counter,
       f.next_label AS label_time_of_day, f.next_us // 1000 AS closed_at_ms,
       f.label AS period_time_of_day
FROM top t JOIN fin f ON f.topic = t.topic AND f.period = t.period WHERE t.rk <= 20
""")
def period_top_tokens(spark, sf_dir):
    ev = events(spark, sf_dir, "ts", "event_type", "props")
    ev = ev.select(F.col("event_type").alias("topic"), "ts",
                   F.get_json_object("props", "$.k").alias("acronym"))
    return periods.period_top_acronyms(ev, "topic", "ts", "acronym", window_ms=10_000)


# ----------------------------------------------------- Q10 deliveries
_DELIVERY_CTE = """
WITH o AS (SELECT o_orderkey, min(o_orderdate) AS o_orderdate FROM orders GROUP BY o_orderkey),
c AS (SELECT l.l_orderkey, l.l_linenumber, o.o_orderkey,
             epoch_us(l.l_shipdate) - epoch_us(o.o_orderdate) AS lateness_us
      FROM lineitem l LEFT JOIN o ON o.o_orderkey = l.l_orderkey),
s AS (SELECT *, CASE WHEN o_orderkey IS NULL THEN 'orphan' WHEN lateness_us < 0 THEN 'before_order'
                     WHEN lateness_us > 259200000000 THEN 'late' ELSE 'in_time' END AS status FROM c)
"""


def _classified(spark, sf_dir):
    use_utc(spark)
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    li = li.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    o = o.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return joins.classify_deliveries(li, o, "l_orderkey", "o_orderkey", "o_orderdate", "l_shipdate")


@register("delivery_lateness", "J-1 AGG-10 F-6 F-7 P-11", _DELIVERY_CTE + """
SELECT l_orderkey, l_linenumber, lateness_us, CAST(259200 AS BIGINT) AS deadline_s, status
FROM s WHERE status IN ('in_time', 'late')
""")
def delivery_lateness(spark, sf_dir):
    c = _classified(spark, sf_dir)
    return c.filter(F.col("status").isin(joins.IN_TIME, joins.LATE)).select(
        "l_orderkey", "l_linenumber", "lateness_us", "deadline_s", "status")


@register("delivery_summary", "AGG-9 VAL-1 VAL-2", _DELIVERY_CTE + """
SELECT count(*) FILTER (WHERE status = 'in_time') AS in_time,
       count(*) FILTER (WHERE status = 'late') AS late,
       count(*) FILTER (WHERE status = 'before_order') AS before_order,
       count(*) FILTER (WHERE status = 'orphan') AS orphan
FROM s
""")
def delivery_summary(spark, sf_dir):
    return joins.lateness_summary(_classified(spark, sf_dir))


@register("invalid_deliveries", "VAL-2", _DELIVERY_CTE + """
SELECT l_orderkey, l_linenumber, lateness_us FROM s WHERE status = 'before_order'
""")
def invalid_deliveries(spark, sf_dir):
    c = _classified(spark, sf_dir)
    return c.filter(F.col("status") == joins.BEFORE_ORDER).select(
        "l_orderkey", "l_linenumber", "lateness_us")


@register("orphans", "J-3 VAL-1", """
SELECT l_orderkey, l_linenumber FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
""")
def orphans(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders", "o_orderkey")
    return joins.orphans(li, o, "l_orderkey", "o_orderkey")


# -------------------------------------------------- R-1 weighted split
@register("weighted_split", "R-1 VAL-4", """
WITH e AS (SELECT event_id, ((event_id * 7919) % 10000) / CAST(10000.0 AS DOUBLE) AS p FROM events)
SELECT event_id, p, CASE WHEN p <= 0.25 THEN 'HuaweiAppStore' WHEN p <= 0.5 THEN 'AppleAppStore'
                         WHEN p <= 0.75 THEN 'GooglePlay' WHEN p <= 1.0 THEN 'RuStore' END AS store
FROM e
""")
def weighted_split(spark, sf_dir):
    ev = events(spark, sf_dir, "event_id")
    ev = ev.withColumn("p", ((F.col("event_id") * 7919) % 10000) / F.lit(10000.0))
    return weights.assign(ev, "p", weights.weights_frame(spark), "stores", "store")


# ------------------------------------------------ R-2 sorted comments
@register("comments_sorted", "R-2 SRC-4 SRC-5 SNK-2 K-3 P-5 F-5", """
SELECT CAST(event_id AS VARCHAR) AS comment_id, CAST(user_id AS VARCHAR) AS user,
       event_type AS topic, json_extract_string(props, '$.k') AS acronym,
       epoch_us(ts) // 1000 AS time_ms
FROM events
""")
def comments_sorted(spark, sf_dir):
    # Stand-in input: events written as the headered comment file
    # (commentId, time offset from t0 in ms, user, topic, acronym).
    comments = files.read_comments(spark, _comment_files(spark, sf_dir))
    return comments.select(F.col("commentId").alias("comment_id"), "user", "topic",
                           F.col("acronim").alias("acronym"),
                           epoch_ms(rebase_ms("time")).alias("time_ms"))


# ----------------------------------------------------- streaming forms
#: Rows wait this long for event order: 6 hours hold a few rows of a user, some hundred of a store.
_BUCKET_MS = 6 * HOUR_MS


def _as_stream(df, time_col, **how):
    """Stand-in input: the rows of ``df`` as files in order of time, read one per micro-batch with a
    watermark of 10 s, and the end of that input (see ``streaming.replay``)."""
    from eventide.streaming.replay import replay
    return replay(df, time_col, **how)


@register("stream_errors_per_window", "S-1 S-3 S-4 S-14 AGG-5 P-6 SRC-3", _ERRORS_SQL + "SELECT * FROM c")
def stream_errors_per_window(spark, sf_dir):
    """Errors per store and day from the events read as a stream of
    files, append mode; the input is ended, so the last open day comes out."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _as_stream(events(spark, sf_dir, "ts", "user_id", "event_type"), "ts")
    err = st.filter(sio.or_end(F.col("event_type") == "error", "ts")).withColumn("store", F.col("user_id") % 4)
    out = sjobs.error_windows(err, "ts", "store", size_ms=24 * HOUR_MS).withColumnRenamed("n", "n_errors")
    return sio.run_to_table(out.select("window_start_ms", "window_end_ms", "store", "n_errors"),
                            "errors_per_window", ends=(end,))


@register("stream_previous_jump", "W-1 P-10 S-11 S-13 S-14 SRC-3", REGISTRY["previous_jump"].sql)
def stream_previous_jump(spark, sf_dir):
    """Previous-value jumps from the events read as a stream: rows wait in windows until the
    watermark has passed them, the previous value is keyed value state (transformWithState)."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _as_stream(events(spark, sf_dir, "ts", "user_id", "event_id", "value"), "ts")
    st = st.withColumn("click_count", F.floor("value").cast("long") % 10)
    out = sjobs.click_jumps(st, "user_id", ["ts", "event_id"], "click_count", ["event_id", "ts"],
                            last_name="last_click_count", event_time="ts", bucket_ms=_BUCKET_MS)
    table_ = sio.run_to_table(out, "previous_jump", ends=(end,))
    return table_.select("user_id", "event_id", epoch_ms("ts").alias("ts_ms"), "click_count",
                         "last_click_count")


@register("stream_threshold_top_apps", "W-2 S-9 S-11 S-12 S-13 AGG-13 K-1", REGISTRY["threshold_top_apps"].sql)
def stream_threshold_top_apps(spark, sf_dir):
    """Q6 as a stream in event order: counters in value state, counts per app in
    map state."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _as_stream(_store_events(spark, sf_dir), "ts")
    main = st.filter(sio.or_end(null_safe_not(F.col("kind") == "error"), "ts"))
    out = sjobs.store_batches(main, "store", ["ts", "event_id"], "kind", "app", event_time="ts", bucket_ms=_BUCKET_MS)
    return sio.run_to_table(out, "top_apps", ends=(end,))


@register("stream_min_max", "S-5 AGG-4 S-14", REGISTRY["sliding_min_max"].sql)
def stream_min_max(spark, sf_dir):
    """Q4 as a stream: the batch operator over a watermarked input."""
    from eventide.streaming import io as sio
    st, end = _as_stream(events(spark, sf_dir, "ts", "event_type", "value"), "ts")
    out = windows.window_min_max(st, "ts", "value", 2 * HOUR_MS, keys=["event_type"], slide_ms=HOUR_MS)
    return sio.run_to_table(out, "min_max", ends=(end,))


@register("stream_click_sessions", "S-6 AGG-3 S-14", REGISTRY["click_sessions"].sql)
def stream_click_sessions(spark, sf_dir):
    """Q3 as a stream: event-time sessions over all rows."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _as_stream(events(spark, sf_dir, "ts"), "ts")
    return sio.run_to_table(sjobs.click_sessions(st, "ts", 10 * 60 * 1000), "sessions", ends=(end,))


@register("stream_busiest_window", "S-5 S-7 S-14 S-15 AGG-7", REGISTRY["busiest_window"].sql)
def stream_busiest_window(spark, sf_dir):
    """Q9 as a stream: sliding counts chained into sessions of windows."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _as_stream(events(spark, sf_dir, "ts"), "ts")
    out = sjobs.busiest_window(st, "ts", 2 * HOUR_MS, HOUR_MS, 3 * HOUR_MS)
    return sio.run_to_table(out, "busiest", ends=(end,))


@register("stream_period_top_tokens", "S-4 S-12 S-14 S-15 W-3 W-4 W-5 AGG-11 AGG-12 K-2",
          REGISTRY["period_top_tokens"].sql)
def stream_period_top_tokens(spark, sf_dir):
    """Q8 as a stream: windowed counts chained into the period state machine."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    ev = events(spark, sf_dir, "ts", "event_type", "props").select(
        F.col("event_type").alias("topic"), "ts", F.get_json_object("props", "$.k").alias("acronym"))
    st, end = _as_stream(ev, "ts")
    return sio.run_to_table(sjobs.acronym_periods(st, "topic", "ts", "acronym"), "periods", ends=(end,))


@register("stream_article_counts", "P-1 P-2 AGG-1 S-2", REGISTRY["article_counts"].sql)
def stream_article_counts(spark, sf_dir):
    """Q1 as a stream without a watermark: counts so far, complete mode."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    path = f"{sf_dir.rstrip('/')}/documents.parquet"
    st = sio.read_parquet_stream(spark, path, spark.read.parquet(path).schema).select("text")
    out = sio.run_to_table(sjobs.article_counts(st), "articles", output_mode="complete")
    return out.select("token", F.col("count").alias("n"))


#: Orders come twice, the second time after 5 days; both streams wait 10 days.
_AGAIN_MS, _ORDER_DELAY_MS = 5 * 24 * HOUR_MS, 10 * 24 * HOUR_MS


def _orders_twice(spark, sf_dir, stretch=None):
    """The orders as a stream in which every order comes twice (at-least-once delivery): the repeat lies in
    the same file or in the next one."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return _as_stream(o, "o_orderdate", delay_ms=_ORDER_DELAY_MS, stretch=stretch, copies=(F.lit(True), _AGAIN_MS))


@register("stream_first_orders", "AGG-8 S-1 S-14", """
SELECT o_orderkey, epoch_us(o_orderdate) // 1000 AS order_ms FROM orders
""")
def stream_first_orders(spark, sf_dir):
    """The first row of each order id from a stream that repeats them."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    use_utc(spark)
    st, end = _orders_twice(spark, sf_dir)
    out = sio.run_to_table(sjobs.first_arrivals(st, "o_orderkey"), "first_orders", ends=(end,))
    return out.filter(F.col("o_orderdate") < F.lit(sio.FAR).cast("timestamp")).select("o_orderkey", epoch_ms("o_orderdate").alias("order_ms"))


@register("stream_deliveries", "J-2 AGG-8 VAL-1 VAL-2 S-1 S-14", """
SELECT l_orderkey, l_linenumber, epoch_us(l_shipdate) // 1000 AS delivery_ms, epoch_us(l_shipdate) - epoch_us(o_orderdate) AS lateness_us,
       CASE WHEN o_orderkey IS NULL THEN 'unmatched' WHEN l_shipdate < o_orderdate THEN 'before_order'
            WHEN epoch_us(l_shipdate) - epoch_us(o_orderdate) > 259200000000 THEN 'late' ELSE 'in_time' END AS status
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
  AND o_orderdate BETWEEN l_shipdate - INTERVAL 60 DAY AND l_shipdate + INTERVAL 20 DAY
""")
def stream_deliveries(spark, sf_dir):
    """Q10 as a stream-stream join with bounds of days: orders come twice and are deduplicated before the
    join, a delivery waits 20 days for its order and an order 60 days for its deliveries, then they leave the state."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    from eventide.streaming.replay import stretch_ms
    use_utc(spark)
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    li = li.withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    stretch = stretch_ms(li, "l_shipdate")
    ds, end_d = _as_stream(li, "l_shipdate", stretch=stretch)
    os_, end_o = _orders_twice(spark, sf_dir, stretch)
    out = sjobs.delivery_matches(os_, ds, "o_orderkey", "o_orderdate", "l_orderkey", "l_shipdate",
                                 after_days=60, before_days=20, first="arrival")
    done = sio.run_to_table(out, "deliveries", ends=(end_o, end_d))
    return done.filter(F.col("l_shipdate") < F.lit(sio.FAR).cast("timestamp")).select(
        "l_orderkey", "l_linenumber", epoch_ms("l_shipdate").alias("delivery_ms"), "lateness_us", "status")


# ------------------------------------------------------- late rows (S-1, S-10)
#: Every 20th event comes two files after its time; a file holds six days.
_HELD_UP, _HELD_UP_FILES, _STRETCH_MS = "event_id % 20 = 7", 2, 144 * HOUR_MS


def _late_events(spark, sf_dir, *columns):
    ev = events(spark, sf_dir, "event_id", "ts", *columns)
    return _as_stream(ev, "ts", stretch=_STRETCH_MS, held_up=(F.expr(_HELD_UP), _HELD_UP_FILES))


_ARRIVED_SQL = late_sql("events", "ts", _STRETCH_MS, _HELD_UP, _HELD_UP_FILES)


@register("stream_late_errors", "S-1 S-3 S-4 S-10 S-14 AGG-5 P-6 SRC-3", _ARRIVED_SQL + """
SELECT epoch_us(ts) // 86400000000 * 86400000 AS window_start_ms, epoch_us(ts) // 86400000000 * 86400000 + 86400000 AS window_end_ms,
       user_id % 4 AS store, count(*) AS n_errors
FROM arrived WHERE event_type = 'error' AND epoch_us(ts) // 86400000000 * 86400000 + 86400000 > wm GROUP BY ALL
""")
def stream_late_errors(spark, sf_dir):
    """``stream_errors_per_window`` with rows that are held up: those whose day the watermark has passed are dropped."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _late_events(spark, sf_dir, "user_id", "event_type")
    err = st.filter(sio.or_end(F.col("event_type") == "error", "ts")).withColumn("store", F.col("user_id") % 4)
    out = sjobs.error_windows(err, "ts", "store", size_ms=24 * HOUR_MS).withColumnRenamed("n", "n_errors")
    return sio.run_to_table(out.select("window_start_ms", "window_end_ms", "store", "n_errors"), "late_errors", ends=(end,))


@register("stream_late_jumps", "W-1 P-10 S-1 S-10 S-11 S-13 S-14 SRC-3", _ARRIVED_SQL + f""",
c AS (SELECT user_id, event_id, ts, CAST(floor(value) AS BIGINT) % 10 AS click_count FROM arrived
      WHERE epoch_us(ts) // {_BUCKET_MS * 1000} * {_BUCKET_MS} + {_BUCKET_MS} > wm),
l AS (SELECT *, lag(click_count, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last_click_count FROM c)
SELECT user_id, event_id, epoch_us(ts) // 1000 AS ts_ms, click_count, last_click_count
FROM l WHERE click_count = 0 OR click_count - last_click_count > 5
""")
def stream_late_jumps(spark, sf_dir):
    """``stream_previous_jump`` with rows that are held up: those whose waiting window has come out are dropped, the others
    take their place in event order."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _late_events(spark, sf_dir, "user_id", "value")
    st = st.withColumn("click_count", F.floor("value").cast("long") % 10)
    out = sjobs.click_jumps(st, "user_id", ["ts", "event_id"], "click_count", ["event_id", "ts"],
                            last_name="last_click_count", event_time="ts", bucket_ms=_BUCKET_MS)
    return sio.run_to_table(out, "late_jumps", ends=(end,)).select(
        "user_id", "event_id", epoch_ms("ts").alias("ts_ms"), "click_count", "last_click_count")


@register("stream_late_sessions", "S-1 S-6 S-10 S-14 AGG-3", _ARRIVED_SQL + """,
t AS (SELECT epoch_us(ts) AS us FROM arrived WHERE (epoch_us(ts) // 600000000 + 1) * 600000 > wm),
f AS (SELECT us, CASE WHEN us - lag(us) OVER (ORDER BY us) <= 600000000 THEN 0 ELSE 1 END AS s FROM t),
g AS (SELECT us, sum(s) OVER (ORDER BY us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f)
SELECT min(us) // 1000 AS session_start_ms, (max(us) + 600000000) // 1000 AS session_end_ms, count(*) AS clicks
FROM g GROUP BY sid
""")
def stream_late_sessions(spark, sf_dir):
    """``stream_click_sessions`` with rows that are held up: those whose bucket of ten minutes has closed are dropped."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    st, end = _late_events(spark, sf_dir)
    return sio.run_to_table(sjobs.click_sessions(st, "ts", 10 * 60 * 1000), "late_sessions", ends=(end,))


# ------------------------------------------------ sinks, sources and reports of streams
@register("stream_split_outputs", "SNK-3 P-6 SRC-3", f"""
SELECT CASE WHEN event_type = 'error' THEN 'side' ELSE 'main' END AS output, {_SPLIT_COLS} FROM events
""")
def stream_split_outputs(spark, sf_dir):
    """The main and the side output of one stream as two tables, each row in one of them once."""
    from eventide.streaming import io as sio
    ev = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "value").withColumn("ts_ms", epoch_ms("ts"))
    st, _ = _as_stream(ev, "ts", delay_ms=None)
    side, root = F.col("event_type") == "error", scratch_path(spark, "split-outputs")
    sio.fan_out_tables(st, "split_outputs", root, {"side": lambda b: b.filter(side), "main": lambda b: b.filter(null_safe_not(side))}).awaitTermination()
    both = [sio.read_fan_out(spark, root, out, ev.schema).withColumn("output", F.lit(out)) for out in ("side", "main")]
    return both[0].unionByName(both[1]).select("output", "event_id", "ts_ms", "user_id", "event_type", "value")


@register("stream_quiet_report", "S-8 S-2 S-12 AGG-9", _DELIVERY_CTE + "SELECT status, count(*) AS n FROM s GROUP BY status")
def stream_quiet_report(spark, sf_dir):
    """Deliveries by status, reported once no input has come for a second (processing time), by salted keys; the
    reports of a key are added up."""
    from eventide.streaming import io as sio
    from eventide.streaming import jobs as sjobs
    rows = _classified(spark, sf_dir).select((F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(16))).alias("salt"), "status", "l_shipdate")
    st, _ = _as_stream(rows, "l_shipdate", delay_ms=None)
    out = sio.drain_when_quiet(sjobs.quiet_report(st.select("salt", "status"), "salt", "status", gap_ms=1000), "quiet_report")
    return out.groupBy("status").agg(F.sum("n").alias("n"))


def _comment_files(spark, sf_dir):
    """The events as the comment job's sorted headerless CSV; its folder."""
    ev = events(spark, sf_dir, "event_id", "ts", "user_id", "event_type", "props")
    raw, dst = scratch_path(spark, "comments-raw"), scratch_path(spark, "comments-sorted")
    ev.select(F.col("event_id").cast("string").alias("commentId"), (epoch_ms("ts") - F.lit(T0_MS)).alias("time"),
              F.col("user_id").cast("string").alias("user"), F.col("event_type").alias("topic"),
              F.get_json_object("props", "$.k").alias("acronym")).write.option("header", True).csv(raw)
    files.sort_comments_file(spark, raw, dst)
    return dst


@register("stream_comment_windows", "SRC-4 P-5 S-1 S-4 S-14 AGG-11 F-5", """
SELECT event_type AS topic, json_extract_string(props, '$.k') AS acronym, epoch_us(ts) // 3600000000 * 3600000 AS window_start_ms, count(*) AS n
FROM events GROUP BY ALL
""")
def stream_comment_windows(spark, sf_dir):
    """The comment file read as a stream of headerless CSV: comments so far per topic, acronym and hour. The
    part files come in any order, so there is no watermark."""
    from eventide.streaming import io as sio
    use_utc(spark)
    comments = files.read_comments(spark, _comment_files(spark, sf_dir), streaming=True)
    timed = sio.event_time(comments.withColumn("at", rebase_ms("time")), "at", None)
    counts = timed.groupBy("topic", F.col("acronim").alias("acronym"), windows.window_column("at", HOUR_MS).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return sio.run_to_table(counts.select("topic", "acronym", F.unix_millis("w.start").alias("window_start_ms"), "n"),
                            "comment_windows", output_mode="complete")


@register("comments_order", "K-3 SNK-2 R-2 SRC-4 SRC-5", """
SELECT CAST(event_id AS VARCHAR) AS comment_id, epoch_us(ts) // 1000 AS time_ms,
       row_number() OVER (ORDER BY epoch_us(ts) // 1000, CAST(event_id AS VARCHAR)) AS place
FROM events
""")
def comments_order(spark, sf_dir):
    """The place of every line in the sorted comment file."""
    lines = files.read_places(spark, _comment_files(spark, sf_dir), files.COMMENT_SCHEMA)
    return lines.select(F.col("commentId").alias("comment_id"), epoch_ms(rebase_ms("time")).alias("time_ms"), "place")


@register("weighted_split_document", "R-1 SRC-6 VAL-4", """
WITH e AS (SELECT event_id, ((event_id * 7919) % 10000) / CAST(10000.0 AS DOUBLE) AS p,
                  ((event_id * 104729) % 10000) / CAST(10000.0 AS DOUBLE) AS q FROM events)
SELECT event_id, CASE WHEN p <= 0.25 THEN 'HuaweiAppStore' WHEN p <= 0.5 THEN 'AppleAppStore'
                      WHEN p <= 0.75 THEN 'GooglePlay' WHEN p <= 1.0 THEN 'RuStore' END AS store,
       CASE WHEN q <= 0.5 THEN 'page_view' WHEN q <= 0.8 THEN 'install' WHEN q <= 0.95 THEN 'uninstall' ELSE 'error' END AS kind
FROM e
""")
def weighted_split_document(spark, sf_dir):
    """Stores and kinds drawn by the weights of a JSON document, loaded from the shared folder."""
    path = scratch_path(spark, "weights")
    files.write_weights(spark, path, {
        "stores": [(n, 0.25) for n in ("HuaweiAppStore", "AppleAppStore", "GooglePlay", "RuStore")],
        "appIds": [("a", 1.0)],
        "eventTypes": [("page_view", 0.5), ("install", 0.3), ("uninstall", 0.15), ("error", 0.05)]}, 100)
    loaded = files.read_weights(spark, path)
    ev = events(spark, sf_dir, "event_id")
    ev = ev.withColumns({"p": ((F.col("event_id") * 7919) % 10000) / F.lit(10000.0),
                         "q": ((F.col("event_id") * 104729) % 10000) / F.lit(10000.0)})
    drawn = weights.assign(weights.assign(ev, "p", loaded, "stores", "store"), "q", loaded, "eventTypes", "kind")
    return drawn.select("event_id", "store", "kind")


# ------------------------------------ operators whose other data cannot fail
@register("unlabelled_documents", "J-3 VAL-1", """
SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def unlabelled_documents(spark, sf_dir):
    return joins.orphans(table(spark, sf_dir, "documents", "doc_id"),
                         table(spark, sf_dir, "labels", "doc_id").withColumnRenamed("doc_id", "label_id"),
                         "doc_id", "label_id")


@register("first_event_per_user", "AGG-8", """
SELECT user_id, event_id, epoch_us(ts) // 1000 AS ts_ms, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
""")
def first_event_per_user(spark, sf_dir):
    ev = events(spark, sf_dir, "user_id", "event_id", "ts", "event_type", "value")
    first = joins.first_per_key(ev, "user_id", ["ts", "event_id"])
    return first.select("user_id", "event_id", epoch_ms("ts").alias("ts_ms"), "event_type", "value")


@register("busiest_windows_small", "S-5 S-7 S-15 AGG-3 AGG-7", """
WITH w AS (
  SELECT (epoch_us(ts) // 1000000 - k) * 1000000 AS ws
  FROM events, (VALUES (0), (1)) AS s(k)),
c AS (SELECT ws, count(*) AS click_count, ws + 2000000 - 1 AS wt FROM w GROUP BY ws),
f AS (SELECT *, CASE WHEN wt - lag(wt) OVER (ORDER BY wt) <= 30000000 THEN 0 ELSE 1 END AS s FROM c),
g AS (SELECT *, sum(s) OVER (ORDER BY wt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY click_count DESC, ws) AS rk FROM g)
SELECT ws // 1000 AS w_start_ms, (ws + 2000000) // 1000 AS w_end_ms, click_count FROM r WHERE rk = 1
""")
def busiest_windows_small(spark, sf_dir):
    """Q9 with the reference's 2 s windows every 1 s and 30 s sessions: many sessions."""
    return sessions.busiest_window(events(spark, sf_dir, "ts"), "ts", 2000, 1000, 30_000)


@register("parsed_instants", "F-4 F-8", """
SELECT event_id, epoch_us(ts) // 1000 AS ts_ms FROM events
""")
def parsed_instants(spark, sf_dir):
    """ISO text made of the events' times, parsed by the library."""
    ev = events(spark, sf_dir, "event_id", "ts")
    iso = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("iso"))
    return iso.select("event_id", epoch_ms(parse_instant("iso")).alias("ts_ms"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql.strip() for name, q in REGISTRY.items() if q.sql}


def bench_queries() -> list[str]:
    """All queries of this catalog."""
    return list(REGISTRY)
