"""Live sales dashboard, as a batch job over event time.

Stage 1 (per category): a calendar-day window (days start at 16:00 UTC, i.e.
midnight UTC+8) with an early result at every tick: the running total of the
day so far, rounded to cents, stamped with the tick time. A category reports
at every tick of the day after its first sale (the trigger keeps firing).

Stage 2 (per tick): the sum of the stage-1 totals of that tick, and the top 3
categories (ties broken by category name).

Scale: sales are pre-aggregated to one row per ``(category, day, tick)``
with partial aggregation before the first shuffle, so a category holding a
third of all sales costs one row per tick. Everything after that works on
at most ``categories x ticks`` rows; the top 3 is a ``WindowGroupLimit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.functions.money import exact_money, round_half_up
from tidewater.functions.timefn import clock_text
from tidewater.operators.topk import top_k
from tidewater.sources.tables import read_table

DAY_START = "16 hours"   # window offset -8 h: days begin at midnight UTC+8
TICK = "1 hour"          # early-fire interval (1 s in the live job)
TOP_N = 3
CLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"   # what clock_text produces

# The printed labels of the dashboard line.
LINE_TIME = "时间 ： "
LINE_TOTAL = "  总价 : "
LINE_TOP = " top3:\n"
ITEM_OPEN = "(分类："
ITEM_TOTAL = " 销售总额："
ITEM_CLOSE = ")"
ITEM_SEP = ",\n"


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_type", "ts", "value"])
    return ev.select(F.col("event_type").alias("category"), "ts", F.col("value").alias("price"))


def category_ticks(sales: DataFrame, day_start: str = DAY_START, tick: str = TICK, arrival: str | None = None) -> DataFrame:
    """Stage 1: ``(category, tick, date_time, total_price)``, and ``first_sale``, the smallest ``arrival`` of the day so
    far, if that column is named. A total stands until the tick before the next sale's, so each row is repeated up to there."""
    # one window expression per projection (Spark assigns windows per Project)
    first = [arrival] if arrival else []
    per_tick = (sales
                .select("category", "ts", F.window("ts", tick)["end"].alias("tick"), "price", *first)
                .select("category", F.window("ts", "1 day", "1 day", day_start).alias("day"), "tick", "price", *first)
                .groupBy("category", F.col("day.start").alias("day_start"), F.col("day.end").alias("day_end"), "tick")
                .agg(F.sum(exact_money("price")).alias("amount"), *[F.min(c).alias("_first") for c in first]))
    w = Window.partitionBy("category", "day_start").orderBy("tick")
    upto, step = w.rowsBetween(Window.unboundedPreceding, 0), F.expr(f"INTERVAL {tick}")
    running = per_tick.select(
        "category", "tick", F.coalesce(F.sum("amount").over(upto), F.lit(0)).alias("running"),
        F.coalesce(F.lead("tick").over(w) - step, "day_end").alias("until"), *[F.min("_first").over(upto).alias("first_sale") for _ in first])
    # every tick from the first sale of the day up to the end of the day (<= 24 per day)
    filled = running.withColumn("tick", F.explode(F.sequence("tick", "until", step)))
    return filled.select("category", "tick", clock_text("tick").alias("date_time"),
                         round_half_up("running", 2).cast("double").alias("total_price"), *["first_sale" for _ in first])


def tick_totals(stage1: DataFrame) -> DataFrame:
    """Stage 2 total: ``(date_time, category_count, total_price)``; rounded
    totals are summed, then rounded again."""
    return stage1.groupBy("date_time").agg(
        F.count(F.lit(1)).alias("category_count"),
        round_half_up(F.sum(exact_money("total_price")), 2).cast("double").alias("total_price"))


def tick_top(stage1: DataFrame, n: int = TOP_N) -> DataFrame:
    """Stage 2 ranking: ``(date_time, rank, category, total_price)``."""
    return top_k(stage1.select("date_time", "category", "total_price"), ["date_time"],
                 [F.col("total_price").desc(), F.col("category")], n)


def dashboard_lines(stage1: DataFrame, n: int = TOP_N) -> DataFrame:
    """The printed dashboard line per tick: ``(date_time, line)``. Total and ranking come from one pass over stage 1: both are
    windows of the tick (one row per category), and only the first ``n`` rows of a tick go on."""
    tick = Window.partitionBy("date_time")
    rank = F.row_number().over(tick.orderBy(F.col("total_price").desc(), "category"))
    total = round_half_up(F.sum(exact_money("total_price")).over(tick), 2).cast("double")
    item = F.concat(F.lit(ITEM_OPEN), "category", F.lit(ITEM_TOTAL), F.col("total_price").cast("string"), F.lit(ITEM_CLOSE))
    top = stage1.select("date_time", rank.alias("rank"), total.alias("total"), item.alias("item")).where(F.col("rank") <= n)
    # at most n items per tick are collected
    lines = top.groupBy("date_time").agg(F.max("total").alias("total"), F.array_sort(F.collect_list(F.struct("rank", "item"))).alias("items"))
    return lines.select("date_time", F.concat(
        F.lit(LINE_TIME), "date_time", F.lit(LINE_TOTAL), F.col("total").cast("string"), F.lit(LINE_TOP),
        F.array_join(F.transform("items", lambda s: s["item"]), ITEM_SEP)).alias("line"))


def running_day_total(spark, sf_dir):
    return category_ticks(_sales(spark, sf_dir))


def sales_dashboard(spark, sf_dir):
    return tick_totals(category_ticks(_sales(spark, sf_dir)))


def top3_categories(spark, sf_dir):
    return tick_top(category_ticks(_sales(spark, sf_dir)))


def sales_dashboard_line(spark, sf_dir):
    return dashboard_lines(category_ticks(_sales(spark, sf_dir)))


_STAGE1 = """
  h AS (SELECT event_type AS category,
               time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01 16:00:00') AS day_start,
               time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01 00:00:00') + INTERVAL '1 hour' AS tick,
               sum(CAST(value AS DECIMAL(18,2))) AS amount
        FROM events GROUP BY ALL),
  f AS (SELECT category, day_start, min(tick) AS first_tick FROM h GROUP BY ALL),
  g AS (SELECT category, day_start,
               unnest(generate_series(first_tick, day_start + INTERVAL '1 day', INTERVAL '1 hour')) AS tick FROM f),
  r AS (SELECT g.category, g.tick,
               sum(coalesce(h.amount, 0)) OVER (PARTITION BY g.category, g.day_start ORDER BY g.tick
                                                ROWS UNBOUNDED PRECEDING) AS running
        FROM g LEFT JOIN h ON g.category = h.category AND g.day_start = h.day_start AND g.tick = h.tick),
  s1 AS (SELECT category, tick, strftime(tick, '%Y-%m-%d %H:%M:%S') AS date_time,
                CAST(round(running, 2) AS DOUBLE) AS total_price FROM r)"""

_TOTALS = """
  t AS (SELECT date_time, count(*) AS category_count,
               CAST(round(sum(CAST(total_price AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_price
        FROM s1 GROUP BY date_time)"""

_TOP = """
  k AS (SELECT date_time, category, total_price,
               row_number() OVER (PARTITION BY date_time ORDER BY total_price DESC, category) AS rank
        FROM s1)"""

ORACLE = {
    "running_day_total": f"WITH {_STAGE1} SELECT * FROM s1",
    "sales_dashboard": f"WITH {_STAGE1}, {_TOTALS} SELECT * FROM t",
    "top3_categories": f"""WITH {_STAGE1}, {_TOP}
        SELECT date_time, category, total_price, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 3""",
    "sales_dashboard_line": f"""WITH {_STAGE1}, {_TOTALS}, {_TOP},
      items AS (SELECT date_time, string_agg('{ITEM_OPEN}' || category || '{ITEM_TOTAL}'
                                             || CAST(total_price AS VARCHAR) || '{ITEM_CLOSE}', ',' || chr(10)
                                             ORDER BY rank) AS txt
                FROM k WHERE rank <= 3 GROUP BY date_time)
      SELECT t.date_time, '{LINE_TIME}' || t.date_time || '{LINE_TOTAL}' || CAST(t.total_price AS VARCHAR)
             || ' top3:' || chr(10) || items.txt AS line
      FROM t JOIN items ON t.date_time = items.date_time""",
}

QUERIES = {
    "running_day_total": running_day_total,
    "sales_dashboard": sales_dashboard,
    "top3_categories": top3_categories,
    "sales_dashboard_line": sales_dashboard_line,
}
