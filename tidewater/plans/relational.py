"""Relational and connector jobs over the TPC-H-like tables and events:
lookup enrichment, unions, connect, side outputs, inline rows, ranges,
counters, rebalancing, resumable ingest and snapshot polls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.aggregate import observed_count as _observed
from tidewater.operators.basic import connect_map, even_odd_tag, tag_rows, union_all
from tidewater.operators.enrich import dedupe_last, lookup_join
from tidewater.session import scratch_path
from tidewater.sinks.round_robin import dealt
from tidewater.sinks.text import write_text
from tidewater.sources.inline import inclusive_range, inline_rows as _inline
from tidewater.sources.jdbc import tag_poll
from tidewater.sources.tables import read_table

# Fixed values of the reference programs.
STRING_PREFIX = "String -> String:"
LONG_PREFIX = "Long -> String:"
ACCTBAL_CUT = 2000.0          # "amount > 2" / "amount < 2", scaled to account balances
SEQUENCE_FILTER_MIN = 10      # "value > 10" before the rebalance
REBALANCE_PARTITIONS = 8
MISSING_REGION = 1            # nations of this region are left out of the lookup, so '' occurs
INLINE_EVENT_TYPES = ("click", "purchase", "view")
POLLS = 2


def broadcast_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    dim = dedupe_last(nation.where(F.col("n_regionkey") != MISSING_REGION), "n_nationkey", "n_name") \
        .select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nation_name"))
    out = lookup_join(cust, dim, "c_nationkey", {"nation_name": ""})
    return out.select("c_custkey", "nation_name", "c_name", "c_acctbal")


def union_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_table(spark, sf_dir, "customer").createOrReplaceTempView("tw_order_a")
    read_table(spark, sf_dir, "supplier").createOrReplaceTempView("tw_order_b")
    return spark.sql(f"""
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM tw_order_a WHERE c_acctbal > {ACCTBAL_CUT}
        UNION ALL
        SELECT s_suppkey AS id, s_name AS name, s_acctbal AS amount FROM tw_order_b WHERE s_acctbal < {ACCTBAL_CUT}""")


def union_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read_table(spark, sf_dir, "customer", ["c_nationkey", "c_name"]).toDF("nationkey", "name")
    b = read_table(spark, sf_dir, "supplier", ["s_nationkey", "s_name"]).toDF("nationkey", "name")
    return union_all(a, b)


def connect_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = read_table(spark, sf_dir, "customer", ["c_name"])
    keys = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    return connect_map(
        names, lambda d: d.select(F.concat(F.lit(STRING_PREFIX), "c_name").alias("value")),
        keys, lambda d: d.select(F.concat(F.lit(LONG_PREFIX), F.col("o_orderkey").cast("string")).alias("value")),
    )


def split_even_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = read_table(spark, sf_dir, "orders", ["o_orderkey"]).withColumnRenamed("o_orderkey", "value")
    return tag_rows(keys, even_odd_tag("value"))


def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A literal list of event types (driver-side rows) used to select events."""
    wanted = _inline(spark, [(t,) for t in INLINE_EVENT_TYPES], "event_type string")
    ev = read_table(spark, sf_dir, "events", ["event_type"])
    picked = ev.join(F.broadcast(wanted), "event_type", "left_semi")  # literal list: size known
    return picked.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


def sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id from the smallest to the largest event id, both ends included."""
    bounds = read_table(spark, sf_dir, "events", ["event_id"]).agg(
        F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    return inclusive_range(spark, bounds["lo"], bounds["hi"])


def observed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by all tasks of a text sink, counted by a job-wide counter."""
    ev = read_table(spark, sf_dir, "events", ["event_type"])
    counted, obs = _observed(ev, "element_counter")
    write_text(counted, scratch_path(spark, "observed_count"), column="event_type")
    return spark.createDataFrame([(int(obs.get["rows"]),)], "processed long")


def partition_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a filter, exact round-robin rebalance; report the partitions used, all rows, and the rows of the smallest and the
    largest partition, which differ by one at most."""
    ids = read_table(spark, sf_dir, "events", ["event_id"]).where(F.col("event_id") > SEQUENCE_FILTER_MIN)
    sizes = dealt(ids, "event_id", REBALANCE_PARTITIONS).groupBy("partition").agg(F.count(F.lit(1)).alias("rows"))
    return sizes.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("total_rows"),
                     F.min("rows").alias("smallest"), F.max("rows").alias("largest"))


def resumable_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file-stream ingest stopped and restarted on the same checkpoint.

    The events land in two arrivals (before / after the middle timestamp);
    each run drains what is there (``availableNow``) and stops. The second run
    resumes from the checkpoint: every row reaches the sink exactly once.
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value", "ts"])
    mid = ev.agg(F.percentile_approx(F.col("event_id"), 0.5).alias("m")).first()["m"]
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("ingest_landing", "ingest_sink", "ingest_ckpt"))
    schema = ev.schema

    def run() -> None:
        src = spark.readStream.schema(schema).parquet(f"{landing}/*")
        q = (src.writeStream.format("parquet").option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start(sink))
        q.awaitTermination()

    ev.where(F.col("event_id") <= mid).write.parquet(f"{landing}/arrival=1")
    run()
    ev.where(F.col("event_id") > mid).write.parquet(f"{landing}/arrival=2")
    run()
    return spark.read.schema(schema).parquet(sink).select("event_id", "user_id", "event_type", "value")


def snapshot_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each poll re-reads the whole table and tags its rows with the poll id
    (the JDBC reader, ``tidewater.sources.jdbc.read_jdbc``, takes the place of
    the parquet read against a live database)."""
    polls = [tag_poll(read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"]), p)
             for p in range(POLLS)]
    return union_all(*polls)


ORACLE = {
    "broadcast_enrich": f"""SELECT c_custkey, coalesce(n.n_name, '') AS nation_name, c_name, c_acctbal
        FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> {MISSING_REGION}) n
        ON c_nationkey = n.n_nationkey""",
    "union_filtered": f"""SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer
        WHERE c_acctbal > {ACCTBAL_CUT}
        UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier WHERE s_acctbal < {ACCTBAL_CUT}""",
    "union_streams": """SELECT c_nationkey AS nationkey, c_name AS name FROM customer
        UNION ALL SELECT s_nationkey, s_name FROM supplier""",
    "connect_streams": f"""SELECT '{STRING_PREFIX}' || c_name AS value FROM customer
        UNION ALL SELECT '{LONG_PREFIX}' || CAST(o_orderkey AS VARCHAR) FROM orders""",
    "split_even_odd": """SELECT o_orderkey AS value, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS tag
        FROM orders""",
    "inline_rows": "SELECT event_type, count(*) AS events FROM events WHERE event_type IN ("
                   + ", ".join(f"'{t}'" for t in INLINE_EVENT_TYPES) + ") GROUP BY event_type",
    "sequence": "SELECT unnest(generate_series(min(event_id), max(event_id))) AS id FROM events",
    "observed_count": "SELECT count(*) AS processed FROM events",
    "partition_balance": f"""WITH m AS (SELECT (row_number() OVER (ORDER BY event_id) - 1) % {REBALANCE_PARTITIONS} AS p
                 FROM events WHERE event_id > {SEQUENCE_FILTER_MIN}),
        s AS (SELECT p, count(*) AS n FROM m GROUP BY p)
        SELECT count(*) AS partitions, CAST(sum(n) AS BIGINT) AS total_rows, min(n) AS smallest, max(n) AS largest FROM s""",
    "resumable_ingest": "SELECT event_id, user_id, event_type, value FROM events",
    "snapshot_poll": f"""SELECT CAST(p AS BIGINT) AS poll_id, c_custkey, c_name, c_nationkey
        FROM customer, range({POLLS}) t(p)""",
}

QUERIES = {
    "broadcast_enrich": broadcast_enrich,
    "union_filtered": union_filtered,
    "union_streams": union_streams,
    "connect_streams": connect_streams,
    "split_even_odd": split_even_odd,
    "inline_rows": inline_rows,
    "sequence": sequence,
    "observed_count": observed_count,
    "partition_balance": partition_balance,
    "resumable_ingest": resumable_ingest,
    "snapshot_poll": snapshot_poll,
}
