"""Streams with a position: polls of a table, a counter that survives a restart, a changelog folded into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.changelog import retract_changelog
from tidewater.session import materialize, scratch_path
from tidewater.sinks.keyed_table import KeyedTable
from tidewater.sources.polled import poll_stream
from tidewater.sources.tables import read_table
from tidewater.streaming.counter import StreamCounter
from tidewater.streaming.feed import SliceFeed, run_available_now

POLLS, PIECES = 4, 4
EPOCHS = 4                # micro-batches of the changelog table


def polled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every poll reads the whole table. The query is stopped when half of the polls are done and started again on its checkpoint."""
    table = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    sink, checkpoint = scratch_path(spark, "polled_sink"), scratch_path(spark, "polled_ckpt")
    for due in (POLLS // 2, POLLS):
        rows = poll_stream(spark, table, "c_custkey", PIECES, due=due)
        query = rows.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return spark.read.schema(rows.schema).parquet(sink)


def observed_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass a stream, counted by a job-wide counter; the query is started anew for every slice."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "event_type"])
    feed = SliceFeed(ev, "event_id", 2, scratch_path(spark, "observed_landing"))
    counter = StreamCounter(spark, scratch_path(spark, "observed_counts"))
    sink = counter.on(feed.stream).writeStream.format("parquet").option("path", scratch_path(spark, "observed_sink"))
    checkpoint = scratch_path(spark, "observed_ckpt")
    while feed.land() or feed.landed == 1:
        counter.store(run_available_now(sink, checkpoint))
        if not feed.todo:
            break
    return counter.total()


def changelog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of ``GROUP BY user_id HAVING count(*) is even``, cut into micro-batches, folded into a keyed table that is compacted
    half way: an insertion sets the user's row, a retraction deletes it. What is left is the query's final result."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id"])
    changes = materialize(retract_changelog(ev, "user_id", "event_id").where(F.col("frequency") % 2 == 0))
    table = KeyedTable(spark, scratch_path(spark, "changelog_table"), "user_id", "long", "frequency", "long", buckets=4)
    bounds = ev.agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi")).first()
    low, width = bounds["lo"] or 0, ((bounds["hi"] or 0) - (bounds["lo"] or 0)) // EPOCHS + 1
    epoch = F.coalesce(F.expr(f"(event_id - {low}) div {width}"), F.lit(0))     # rows without an id come first
    for e in range(EPOCHS):
        table.write_batch(changes.where(epoch == e), e, order=["event_id", "change_seq"], op="op")
        if e == EPOCHS // 2:
            table.compact()
    return table.current()


ORACLE = {
    "polled_customers": f"""SELECT CAST(p AS BIGINT) AS poll_id, c_custkey, c_name, c_nationkey FROM customer, range({POLLS}) t(p)""",
    "observed_count_stream": "SELECT count(*) AS processed FROM events",
    "changelog_table": "SELECT user_id, count(*) AS frequency FROM events GROUP BY user_id HAVING count(*) % 2 = 0",
}

QUERIES = {
    "polled_customers": polled_customers,
    "observed_count_stream": observed_count_stream,
    "changelog_table": changelog_table,
}
