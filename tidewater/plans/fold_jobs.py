"""Jobs on user-given reductions and accumulators: running reduce, mergeable accumulators, a bounded
priority list, and the round-robin sink. Every key is cut into bounded blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.money import exact_money
from tidewater.functions.timefn import epoch_micros, from_epoch_micros
from tidewater.operators.accumulate import accumulate, best_of, longest_gap_of
from tidewater.operators.scan import applied_to_zero, clamped_add, running_reduce, then
from tidewater.plans.dashboard import _STAGE1, TOP_N, category_ticks
from tidewater.plans.text_jobs import status_messages
from tidewater.session import scratch_path
from tidewater.sinks.round_robin import write_round_robin
from tidewater.sources.tables import read_table

# An account per user: purchases and errors take from it, the rest adds; it stays between these amounts.
LOW, HIGH = 0, 500
TAKING = ("purchase", "error")
PARTITIONS = 4            # of the round-robin sink


def running_clamped_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running reduce with a function that neither commutes nor has an inverse: add, then keep within limits."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    change = F.when(F.col("event_type").isin(*TAKING), -exact_money("value")).otherwise(exact_money("value"))
    out = running_reduce(ev, ["user_id"], "event_id", clamped_add(change, LOW, HIGH), then, applied_to_zero, "balance")
    return out.select("event_id", "user_id", F.col("balance").cast("double").alias("balance"))


def longest_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest pause of every user, by an accumulator whose partial states merge in the order of time."""
    ev = read_table(spark, sf_dir, "events", ["user_id", "ts"]).select("user_id", epoch_micros("ts").alias("us"))
    out = accumulate(ev, ["user_id"], longest_gap_of("us"), "g", order="us", chunk_width=60_000_000)
    return out.select("user_id", from_epoch_micros("g.first").alias("first_ts"), from_epoch_micros("g.last").alias("last_ts"),
                      F.col("g.gap").alias("longest_gap_us"), F.col("g.rows").alias("events"))


def top3_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top categories of every tick as a bounded priority list; of equal totals the one that sold first that day
    stays ahead, as in a heap that only a strictly larger total enters."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type", "ts", "value"])
    sales = ev.select(F.col("event_type").alias("category"), "ts", F.col("value").alias("price"), "event_id")
    return top_by_arrival(category_ticks(sales, arrival="event_id"))


def top_by_arrival(stage1: DataFrame, n: int = TOP_N) -> DataFrame:
    """(date_time, rank, category, total_price) from (date_time, total_price, first_sale, category)."""
    def key(x):
        return F.struct(-x["total_price"], x["first_sale"], x["category"])

    best = best_of(n, "struct<total_price:double,first_sale:bigint,category:string>", lambda a, b: key(a) < key(b))
    rows = stage1.select("date_time", "total_price", "first_sale", "category")
    out = accumulate(rows, ["date_time"], best, "best", spread_by=["category"])
    out = out.select("date_time", F.posexplode("best").alias("pos", "item"))
    return out.select("date_time", (F.col("pos") + 1).alias("rank"), "item.category", "item.total_price")


def round_robin_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages dealt to the partitions of a topic in turn; what every partition holds, read back from the sink."""
    path = scratch_path(spark, "round_robin")
    write_round_robin(status_messages(spark, sf_dir, keep=["event_id"]), path, "event_id", PARTITIONS)
    held = spark.read.schema("event_id long, value string, partition long").parquet(path)
    return held.groupBy("partition").agg(F.count(F.lit(1)).alias("messages"), F.sum("event_id").alias("id_sum"),
                                         F.sum(F.length("value").cast("long")).alias("chars"))


_CHANGE = "CASE WHEN event_type IN ({}) THEN -value ELSE value END".format(", ".join(f"'{t}'" for t in TAKING))

ORACLE = {
    "running_clamped_sum": f"""
      WITH RECURSIVE r AS (SELECT event_id, user_id, coalesce(CAST({_CHANGE} AS DECIMAL(18,2)), 0) AS d,
                                  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
      c AS (SELECT event_id, user_id, n, CAST(least({HIGH}, greatest({LOW}, d)) AS DECIMAL(18,2)) AS balance FROM r WHERE n = 1
            UNION ALL
            SELECT r.event_id, r.user_id, r.n, CAST(least({HIGH}, greatest({LOW}, c.balance + r.d)) AS DECIMAL(18,2))
            FROM c JOIN r ON r.user_id IS NOT DISTINCT FROM c.user_id AND r.n = c.n + 1)
      SELECT event_id, user_id, CAST(balance AS DOUBLE) AS balance FROM c""",
    "longest_gap": """
      WITH g AS (SELECT user_id, ts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS gap FROM events)
      SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, max(gap) AS longest_gap_us, count(*) AS events FROM g GROUP BY user_id""",
    "top3_by_arrival": f"""
      WITH {_STAGE1},
      sold AS (SELECT event_type AS category, time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01 16:00:00') AS day_start, min(event_id) AS first_sale
               FROM events GROUP BY ALL),
      k AS (SELECT s1.date_time, s1.category, s1.total_price,
                   row_number() OVER (PARTITION BY s1.tick ORDER BY s1.total_price DESC, sold.first_sale, s1.category) AS rank
            FROM s1 JOIN sold ON s1.category = sold.category AND s1.tick > sold.day_start AND s1.tick <= sold.day_start + INTERVAL '1 day')
      SELECT date_time, category, total_price, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= {TOP_N}""",
    "round_robin_sink": f"""
      WITH m AS (SELECT event_id, to_json(struct_pack(user_id := CAST(user_id AS VARCHAR), page_id := json_extract_string(props, '$.k'),
                        status := CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END))::VARCHAR AS value,
                        row_number() OVER (ORDER BY event_id) - 1 AS i FROM events)
      SELECT i % {PARTITIONS} AS "partition", count(*) AS messages, CAST(sum(event_id) AS BIGINT) AS id_sum, CAST(sum(length(value)) AS BIGINT) AS chars
      FROM m GROUP BY 1""",
}

QUERIES = {
    "running_clamped_sum": running_clamped_sum,
    "longest_gap": longest_gap,
    "top3_by_arrival": top3_by_arrival,
    "round_robin_sink": round_robin_sink,
}
