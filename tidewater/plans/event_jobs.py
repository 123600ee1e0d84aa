"""Keyed running aggregates, windows, lateness and timers over ``events``.

Parameters follow the reference programs with seconds scaled to hours (the
test events are minutes apart): key ``user_id``, arrival order ``event_id``,
value ``value`` (money, summed exactly as decimal).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.money import exact_money
from tidewater.functions.timefn import instant_to_ntz, to_event_time
from tidewater.operators.aggregate import max_row_by_key, running_by_key
from tidewater.operators.changelog import filter_changelog, retract_changelog
from tidewater.operators.lateness import classify_lateness, late_side_output as _late_rows, window_firings
from tidewater.operators.timers import order_timeout as _order_timeout
from tidewater.operators.timers import order_timeout_drain as _drain
from tidewater.operators.windows import count_windows, day_windows, session_windows, sliding, tumbling
from tidewater.session import scratch_path
from tidewater.sources.tables import read_table
from tidewater.streaming.feed import SliceFeed

# Fixed parameters of the reference programs, scaled from seconds to hours.
TUMBLE = "5 hours"          # tumbling window (5 s)
SLIDE_SIZE, SLIDE_STEP = "10 hours", "5 hours"   # sliding window (10 s every 5 s)
SESSION_GAP = "1 hour"      # session gap
OUT_OF_ORDER = "3 hours"    # bounded out-of-orderness (3 s)
SQL_TUMBLE = "5 hours"      # SQL tumble group window
COUNT_SIZE, COUNT_SLIDE = 5, 3
LATE_WINDOW, LATE_BOUND, LATE_ALLOWED = "1 hour", "10 minutes", "20 minutes"
ARRIVAL_MULT, ARRIVAL_SPREAD = 7919, 50  # arrival = event_id + (event_id * 7919) % 50
TIMEOUT = "1 hour"          # order review timeout (5 s)


def _events(spark: SparkSession, sf_dir: str, cols: list[str]) -> DataFrame:
    return read_table(spark, sf_dir, "events", cols)


def running_sum(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"])
    out = running_by_key(ev, "user_id", "event_id", exact_money("value"), "sum", "running_sum")
    return out.withColumn("running_sum", F.col("running_sum").cast("double"))


def running_max(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"])
    return running_by_key(ev, "user_id", "event_id", "value", "max", "max_value")


def max_by_key(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value", "event_type"])
    return max_row_by_key(ev, "user_id", "value", "event_id", ev.columns)


def retract_changelog_q(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id"])
    return retract_changelog(ev, "user_id", "event_id")


def retract_sum_changelog(spark, sf_dir):
    """The changelog of a running sum: the first row of a key is known by its row count, so sums that
    return to an earlier value keep their retractions."""
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"]).withColumn("amount", exact_money("value"))
    out = retract_changelog(ev, "user_id", "event_id", "amount", out="total")
    return out.withColumn("total", F.col("total").cast("double"))


def retract_having(spark, sf_dir):
    return filter_changelog(retract_changelog_q(spark, sf_dir), "frequency", 2)


def tumbling_sum(spark, sf_dir):
    return tumbling(_events(spark, sf_dir, ["user_id", "ts", "value"]), ["user_id"], "ts", TUMBLE, "value")


def sliding_sum(spark, sf_dir):
    return sliding(_events(spark, sf_dir, ["user_id", "ts", "value"]), ["user_id"], "ts",
                   SLIDE_SIZE, SLIDE_STEP, "value")


def session_sum(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "ts", "value"])
    return session_windows(ev, ["user_id"], "ts", SESSION_GAP, "value", tie="event_id")


def event_time_tumbling(spark, sf_dir):
    """Structured Streaming: bounded-out-of-order watermark + tumbling window,
    append mode (a window is emitted once, when the watermark passes its end;
    the input arrives in two slices, the closing row ends the last windows)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"])
    feed = SliceFeed(ev, "event_id", 2, scratch_path(spark, "event_time_landing"), ("ts", "30 days"))
    agg = (feed.stream.select("user_id", to_event_time("ts").alias("et"), "value")
           .withWatermark("et", OUT_OF_ORDER)
           .groupBy("user_id", F.window("et", TUMBLE).alias("w"))
           .agg(F.count(F.lit(1)).alias("event_count"), F.sum(exact_money("value")).alias("_s")))
    out = agg.select("user_id", instant_to_ntz(F.col("w.start")).alias("window_start"),
                     instant_to_ntz(F.col("w.end")).alias("window_end"), "event_count",
                     F.col("_s").cast("double").alias("sum_value"))
    sink = scratch_path(spark, "event_time_tumbling")
    feed.drain(out.writeStream.outputMode("append").format("parquet").option("path", sink),
               scratch_path(spark, "event_time_tumbling_ckpt"))
    return spark.read.schema(out.schema).parquet(sink)


def tumble_sql(spark, sf_dir):
    _events(spark, sf_dir, ["user_id", "ts", "value"]).createOrReplaceTempView("tw_t_order")
    return spark.sql(f"""
        SELECT user_id, count(*) AS order_count, max(value) AS max_value, min(value) AS min_value
        FROM tw_t_order GROUP BY user_id, window(ts, '{SQL_TUMBLE}')""")


def count_tumbling(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"])
    return count_windows(ev, ["user_id"], "event_id", COUNT_SIZE, COUNT_SIZE, "value")


def count_sliding(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "value"])
    return count_windows(ev, ["user_id"], "event_id", COUNT_SIZE, COUNT_SLIDE, "value")


def _classified(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "ts", "value"])
    ev = ev.withColumn("arrival", F.col("event_id") + F.pmod(F.col("event_id") * ARRIVAL_MULT, F.lit(ARRIVAL_SPREAD)))
    return classify_lateness(ev, "ts", "arrival", "event_id", LATE_WINDOW, LATE_BOUND, LATE_ALLOWED)


def lateness_classes(spark, sf_dir):
    return _classified(spark, sf_dir).select("event_id", "arrival", "window_end", "lateness_class")


def late_side_output(spark, sf_dir):
    return _late_rows(_classified(spark, sf_dir)).select("event_id", "user_id", "ts", "value")


def late_refires(spark, sf_dir):
    return window_firings(_classified(spark, sf_dir), ["user_id"], "value", "arrival", "event_id")


def day_offset_sum(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_type", "ts", "value"]).withColumnRenamed("event_type", "category")
    return day_windows(ev, ["category"], "ts", "value", offset="16 hours")


def order_timeout(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "ts", "event_type"])
    orders = ev.where(F.col("event_type") == "purchase").withColumnRenamed("event_id", "order_id")
    reviews = ev.where(F.col("event_type") == "click")
    return _order_timeout(orders, reviews, "user_id", "order_id", "ts", TIMEOUT)


def order_timeout_drain(spark, sf_dir):
    ev = _events(spark, sf_dir, ["event_id", "user_id", "ts"]).withColumnRenamed("event_id", "order_id")
    return _drain(ev, "user_id", "order_id", "ts", TIMEOUT)


# ---------------------------------------------------------------- oracle SQL
_DEC = "CAST(value AS DECIMAL(18,2))"
_EPOCH = "TIMESTAMP '1970-01-01 00:00:00'"


def _bucket(size: str, origin: str = _EPOCH) -> str:
    return f"time_bucket(INTERVAL '{size}', ts, {origin})"


_CLASSIFIED = f"""
  a AS (SELECT event_id, user_id, ts, value,
               event_id + (event_id * {ARRIVAL_MULT}) % {ARRIVAL_SPREAD} AS arrival FROM events),
  m AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS mx,
               {_bucket(LATE_WINDOW)} AS ws, {_bucket(LATE_WINDOW)} + INTERVAL '{LATE_WINDOW}' AS we FROM a),
  c AS (SELECT *, CASE WHEN mx < we + INTERVAL '{LATE_BOUND}' THEN 'on_time'
                       WHEN mx < we + INTERVAL '{LATE_BOUND}' + INTERVAL '{LATE_ALLOWED}' THEN 'late_accepted'
                       ELSE 'late_dropped' END AS lateness_class FROM m)"""

_CHANGELOG = """
  WITH r AS (SELECT event_id, user_id,
                    count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS c
             FROM events)
  SELECT * FROM (
    SELECT event_id, 0 AS change_seq, false AS op, user_id, c - 1 AS frequency FROM r WHERE c > 1
    UNION ALL
    SELECT event_id, 1 AS change_seq, true AS op, user_id, c AS frequency FROM r)"""

_WIN_AGGS = f"count(*) AS event_count, CAST(sum({_DEC}) AS DOUBLE) AS sum_value"

ORACLE = {
    "running_sum": f"""SELECT event_id, user_id, value,
        CAST(sum({_DEC}) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE)
        AS running_sum FROM events""",
    "running_max": """SELECT event_id, user_id, value,
        max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS max_value
        FROM events""",
    "max_by_key": """SELECT user_id, event_id, value, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events)
        WHERE rn = 1""",
    "retract_changelog": _CHANGELOG,
    "retract_sum_changelog": f"""WITH r AS (
          SELECT event_id, user_id, count(*) OVER w AS n, sum({_DEC}) OVER w AS s, sum({_DEC}) OVER b AS o FROM events
          WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING),
                 b AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT event_id, 0 AS change_seq, false AS op, user_id, CAST(o AS DOUBLE) AS total FROM r WHERE n > 1
        UNION ALL SELECT event_id, 1, true, user_id, CAST(s AS DOUBLE) FROM r""",
    "retract_having": f"SELECT * FROM ({_CHANGELOG}) WHERE frequency = 2",
    "tumbling_sum": f"""SELECT user_id, {_bucket(TUMBLE)} AS window_start,
        {_bucket(TUMBLE)} + INTERVAL '{TUMBLE}' AS window_end, {_WIN_AGGS}
        FROM events GROUP BY ALL""",
    "sliding_sum": f"""SELECT user_id, ws AS window_start, ws + INTERVAL '{SLIDE_SIZE}' AS window_end, {_WIN_AGGS}
        FROM (SELECT *, unnest([{_bucket(SLIDE_STEP)}, {_bucket(SLIDE_STEP)} - INTERVAL '{SLIDE_STEP}']) AS ws
              FROM events)
        GROUP BY user_id, ws""",
    "session_sum": f"""WITH s AS (
          SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                          <= INTERVAL '{SESSION_GAP}' THEN 0 ELSE 1 END AS nw FROM events),
        g AS (SELECT *, sum(nw) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS sid
              FROM s)
        SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '{SESSION_GAP}' AS window_end, {_WIN_AGGS}
        FROM g GROUP BY user_id, sid""",
    "event_time_tumbling": f"""SELECT user_id, {_bucket(TUMBLE)} AS window_start,
        {_bucket(TUMBLE)} + INTERVAL '{TUMBLE}' AS window_end, {_WIN_AGGS}
        FROM events GROUP BY ALL""",
    "tumble_sql": f"""SELECT user_id, count(*) AS order_count, max(value) AS max_value, min(value) AS min_value
        FROM events GROUP BY user_id, {_bucket(SQL_TUMBLE)}""",
    "count_tumbling": f"""WITH r AS (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
        SELECT user_id, CAST((rn - 1) // {COUNT_SIZE} + 1 AS BIGINT) AS window_index, {_WIN_AGGS},
               max(event_id) AS last_event_id
        FROM r GROUP BY user_id, (rn - 1) // {COUNT_SIZE} HAVING count(*) = {COUNT_SIZE}""",
    "count_sliding": f"""WITH r AS (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
                 count(*) OVER (PARTITION BY user_id ORDER BY event_id
                                ROWS BETWEEN {COUNT_SIZE - 1} PRECEDING AND CURRENT ROW) AS n,
                 sum({_DEC}) OVER (PARTITION BY user_id ORDER BY event_id
                                   ROWS BETWEEN {COUNT_SIZE - 1} PRECEDING AND CURRENT ROW) AS s
          FROM events)
        SELECT user_id, CAST(rn // {COUNT_SLIDE} AS BIGINT) AS window_index, n AS event_count,
               CAST(s AS DOUBLE) AS sum_value, event_id AS last_event_id
        FROM r WHERE rn % {COUNT_SLIDE} = 0""",
    "lateness_classes": f"""WITH {_CLASSIFIED}
        SELECT event_id, arrival, we AS window_end, lateness_class FROM c""",
    "late_side_output": f"""WITH {_CLASSIFIED}
        SELECT event_id, user_id, ts, value FROM c WHERE lateness_class = 'late_dropped'""",
    "late_refires": f"""WITH {_CLASSIFIED},
        o AS (SELECT user_id, ws, we, count(*) AS n, sum({_DEC}) AS s FROM c
              WHERE lateness_class = 'on_time' GROUP BY user_id, ws, we),
        l AS (SELECT user_id, ws, we,
                     row_number() OVER (PARTITION BY user_id, we ORDER BY arrival, event_id) AS firing,
                     sum({_DEC}) OVER (PARTITION BY user_id, we ORDER BY arrival, event_id
                                       ROWS UNBOUNDED PRECEDING) AS ls
              FROM c WHERE lateness_class = 'late_accepted')
        SELECT user_id, ws AS window_start, we AS window_end, CAST(0 AS BIGINT) AS firing,
               n AS event_count, CAST(s AS DOUBLE) AS sum_value FROM o
        UNION ALL
        SELECT l.user_id, l.ws, l.we, l.firing, coalesce(o.n, 0) + l.firing,
               CAST(coalesce(o.s + l.ls, o.s, l.ls) AS DOUBLE)
        FROM l LEFT JOIN o ON l.user_id IS NOT DISTINCT FROM o.user_id AND l.we = o.we""",
    "day_offset_sum": f"""SELECT event_type AS category,
        {_bucket('1 day', "TIMESTAMP '1970-01-01 16:00:00'")} AS window_start,
        {_bucket('1 day', "TIMESTAMP '1970-01-01 16:00:00'")} + INTERVAL '1 day' AS window_end, {_WIN_AGGS}
        FROM events GROUP BY ALL""",
    "order_timeout": f"""WITH o AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
        r AS (SELECT user_id, ts FROM events WHERE event_type = 'click')
        SELECT event_id AS order_id, user_id, ts AS order_ts, ts + INTERVAL '{TIMEOUT}' AS due_at,
               CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.user_id = o.user_id AND r.ts > o.ts
                                 AND r.ts <= o.ts + INTERVAL '{TIMEOUT}')
                    THEN 'reviewed' ELSE 'auto_good_review' END AS status
        FROM o""",
    "order_timeout_drain": """WITH o AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms FROM events)
        SELECT event_id AS order_id, user_id, ms AS order_ms,
               min(ms) OVER (PARTITION BY user_id ORDER BY ms RANGE BETWEEN 3599999 PRECEDING AND CURRENT ROW)
               + 3600000 AS handled_ms,
               CASE WHEN list_sum(list_transform(string_split(CAST(event_id AS VARCHAR), ''),
                                                 lambda ch: unicode(ch))) % 2 = 0
                    THEN 'reviewed' ELSE 'auto_good_review' END AS status
        FROM o""",
}

QUERIES = {
    "running_sum": running_sum,
    "running_max": running_max,
    "max_by_key": max_by_key,
    "retract_changelog": retract_changelog_q,
    "retract_sum_changelog": retract_sum_changelog,
    "retract_having": retract_having,
    "tumbling_sum": tumbling_sum,
    "sliding_sum": sliding_sum,
    "session_sum": session_sum,
    "event_time_tumbling": event_time_tumbling,
    "tumble_sql": tumble_sql,
    "count_tumbling": count_tumbling,
    "count_sliding": count_sliding,
    "lateness_classes": lateness_classes,
    "late_side_output": late_side_output,
    "late_refires": late_refires,
    "day_offset_sum": day_offset_sum,
    "order_timeout": order_timeout,
    "order_timeout_drain": order_timeout_drain,
}
