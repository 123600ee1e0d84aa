"""Streaming forms of the keyed operators.

Each job lands ``events`` slice by slice (the live source), works every slice off
with one query into a parquet sink, and returns the sink. Maxima, counts and changelogs are running aggregates of a micro-batch
with one carry per key (:mod:`tidewater.streaming.carry`); timers are state processors (``transformWithStateInPandas``). Event-time jobs end with a closing row that moves the
watermark past all windows and timers, so the result equals the batch form.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.hashing import char_code_parity
from tidewater.functions.money import exact_money, round_half_up
from tidewater.functions.timefn import clock_text, epoch_micros, from_epoch_micros, instant_to_ntz, to_event_time
from tidewater.plans.dashboard import DAY_START, TICK, dashboard_lines
from tidewater.plans.dashboard import ORACLE as DASHBOARD_ORACLE
from tidewater.operators.windows import duration_micros
from tidewater.operators.basic import even_odd_tag, union_all
from tidewater.session import scratch_path
from tidewater.sources.tables import read_table
from tidewater.plans.event_jobs import (ARRIVAL_MULT, COUNT_SIZE, COUNT_SLIDE, LATE_ALLOWED, LATE_BOUND, LATE_WINDOW, OUT_OF_ORDER,
                                        SESSION_GAP, SLIDE_SIZE, SLIDE_STEP, SQL_TUMBLE, TIMEOUT, TUMBLE)
from tidewater.plans.event_jobs import ORACLE as BATCH_ORACLE
from tidewater.plans.text_jobs import ORACLE as TEXT_ORACLE
from tidewater.plans.text_jobs import STATUS_SCHEMA, status_messages
from tidewater.streaming.feed import SliceFeed, drain_together
from tidewater.functions.jsonfn import rows_to_json
from tidewater.sources.kafka import decode_json_values
from tidewater.sources.text import read_text_lines
from tidewater.streaming.carry import CarryJob, CarryTable, changelog_step, count_window_step, running_max_step
from tidewater.streaming.processors import UNITS, DayTotalProcessor, LateWindowProcessor, OrderTimeoutProcessor

PIECES = 2                 # arrival slices of the table, one micro-batch each
TIMER_WATERMARK = "1 minute"
SQL_BOUND = "2 hours"      # bound of the SQL tumble group window (2 s), scaled
CLOSING = "30 days"        # the closing row is later than any window or timer
LIVE_PIECES = 4            # slices of each source of the live union
TICK_MS = duration_micros(TICK) // 1000
LATE_PIECES = 6            # arrival slices (micro-batches) for the lateness streams
BUCKET_ROWS = 1 << 15       # rows of the table per bucket of users (a state row) in the lateness streams
LATE_SPREAD = 500          # arrival = event_id + (event_id * 7919) % 500: far enough to be late across slices


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """``transformWithState`` needs the RocksDB state store; set it when the
    session has none (a query keeps the provider recorded in its checkpoint)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, None) != ROCKSDB:
        spark.conf.set(key, ROCKSDB)


STATE_ROWS = 1 << 20        # rows of the table per state partition
# state with a row per window: a commit writes the changes and not all of it, and a write does not read the row first (that only serves the
# metric of the number of rows)
WINDOW_STATE = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
                "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}
NO_ID = -(1 << 62)         # stands for a null id inside of the state processors


def _with_id(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.when(F.col(name) != NO_ID, F.col(name)))


def _landed_events(spark: SparkSession, sf_dir: str, cols: list[str], name: str) -> SliceFeed:
    ev = read_table(spark, sf_dir, "events", cols)
    return SliceFeed(ev, "event_id", PIECES, scratch_path(spark, f"{name}_landing"),
                     ("ts", CLOSING) if "ts" in cols else None)


def _few_partitions(spark: SparkSession, feed: SliceFeed) -> dict[str, str]:
    return {"spark.sql.shuffle.partitions": str(_state_partitions(spark, feed))}


def _state_partitions(spark: SparkSession, feed: SliceFeed) -> int:
    """Partitions of a stream's state, fixed at its start: opening and committing one takes a quarter of a second in every micro-batch,
    so no more than keep all cores busy and hold ``STATE_ROWS`` rows of the table each (and not more than the session has)."""
    cores = spark.sparkContext.defaultParallelism
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(cores, -(-feed.rows // STATE_ROWS)))


@contextmanager
def _with_conf(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the time of a stream (it takes them over at its start)."""
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _sink(spark: SparkSession, feed: SliceFeed, stream: DataFrame, name: str, state: dict[str, str] | None = None) -> DataFrame:
    """Drain the feed into a parquet folder and return it; ``state``: session settings for the time of the stream."""
    use_rocksdb_state(spark)
    path = scratch_path(spark, f"{name}_sink")
    with _with_conf(spark, state or {}):
        feed.drain(stream.writeStream.format("parquet").outputMode("append").option("path", path),
                   scratch_path(spark, f"{name}_ckpt"))
    return spark.read.schema(stream.schema).parquet(path)


def _carried(spark: SparkSession, feed: SliceFeed, how, schema: str, name: str) -> DataFrame:
    """Run a step of :mod:`tidewater.streaming.carry` over every slice; the rows that it gave."""
    step, kind = how
    out = scratch_path(spark, f"{name}_out")
    job = CarryJob(CarryTable(scratch_path(spark, f"{name}_carry"), ["user_id"], kind), "user_id long", out, step)
    feed.drain(feed.stream.writeStream.foreachBatch(job), scratch_path(spark, f"{name}_ckpt"))
    return spark.read.schema(schema).parquet(f"{out}/*")


def running_max_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "value"], "running_max_stream")
    return _carried(spark, feed, running_max_step("user_id", "event_id", "value"),
                    "event_id long, user_id long, value double, max_value double", "running_max_stream")


_COUNT_WINDOW = "user_id long, window_index long, event_count long, sum_value double, last_event_id long"


def count_sliding_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "value"], "count_sliding_stream")
    return _carried(spark, feed, count_window_step("user_id", "event_id", "value", COUNT_SIZE, COUNT_SLIDE, exact_money), _COUNT_WINDOW,
                    "count_sliding_stream")


def _late_events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Allowed lateness on a stream: rows arrive in ``arrival`` order in ``LATE_PIECES`` micro-batches; the
    watermark is the engine's (per batch). All firings; ``firing = -1`` rows are the late side output."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "ts", "value"]).withColumn(
        "arrival", F.col("event_id") + F.pmod(F.col("event_id") * ARRIVAL_MULT, F.lit(LATE_SPREAD)))
    feed = SliceFeed(ev, "arrival", LATE_PIECES, scratch_path(spark, f"{name}_landing"), ("ts", CLOSING))
    # users share a state row: as many buckets as keep the state partitions busy, more on a large table
    buckets = max(4 * _state_partitions(spark, feed), feed.rows // BUCKET_ROWS)
    bucket = F.when(F.col("user_id").isNull(), LateWindowProcessor.NO_USER).otherwise(F.pmod(F.xxhash64("user_id"), F.lit(buckets)))
    rows = (feed.stream.select(bucket.cast("long").alias("bucket"), F.coalesce("user_id", F.lit(0)).cast("long").alias("user_id"),
                               F.coalesce("event_id", F.lit(NO_ID)).alias("event_id"), F.coalesce("arrival", F.lit(NO_ID)).alias("arrival"),
                               F.floor(epoch_micros("ts") / 1000).cast("long").alias("ms"),
                               F.coalesce((exact_money("value") * UNITS).cast("long"), F.lit(0)).alias("units"),
                               F.col("value").isNotNull().cast("long").alias("valued"),
                               F.timestamp_micros(epoch_micros("ts")).alias("et"))
            .withWatermark("et", LATE_BOUND)
            # the event-time column stays out of the processor input: the
            # processor classifies late rows itself instead of the engine dropping them
            # (without the closing row: one predicate that reads the event time and can't be split, so it stays above the watermark)
            .where(F.when(F.col("arrival") != feed.closing_order, F.col("et")).isNotNull())
            .select("bucket", "user_id", "event_id", "arrival", "ms", "units", "valued"))
    out = rows.groupBy("bucket").transformWithStateInPandas(
        LateWindowProcessor(duration_micros(LATE_WINDOW) // 1000, duration_micros(LATE_ALLOWED) // 1000),
        "user_id long, window_end_ms long, firing long, event_count long, sum_units long, valued long, event_id long",
        "Append", "EventTime")
    done = _with_id(_sink(spark, feed, out, name, _few_partitions(spark, feed)), "event_id")
    return done.withColumn("sum_value", F.when(F.col("valued") > 0, (F.col("sum_units").cast("decimal(19,0)") / UNITS).cast("double")))


def late_refires_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = _late_events(spark, sf_dir, "late_stream").where("firing >= 0")
    w_us = duration_micros(LATE_WINDOW)
    return fired.select("user_id",
                        from_epoch_micros(F.col("window_end_ms") * 1000 - w_us).alias("window_start"),
                        from_epoch_micros(F.col("window_end_ms") * 1000).alias("window_end"),
                        "firing", "event_count", "sum_value")


def late_side_output_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side output of the same stream: rows beyond the allowed lateness."""
    late = _late_events(spark, sf_dir, "late_side_stream").where("firing = -1")
    return late.select("event_id", "user_id", from_epoch_micros(F.col("window_end_ms") * 1000).alias("window_end"),
                       F.col("sum_value").alias("value"))


def sliding_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows on a stream: append mode emits a window when the watermark passes its end."""
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "ts", "value"], "sliding_stream")
    rows = feed.stream.select("event_id", "user_id", to_event_time("ts").alias("et"), "value").withWatermark("et", OUT_OF_ORDER)
    out = (rows.groupBy("user_id", F.window("et", SLIDE_SIZE, SLIDE_STEP).alias("w"))
           .agg(F.count(F.lit(1)).alias("event_count"), F.sum(exact_money("value")).cast("double").alias("sum_value")))
    return _windows_out(_sink(spark, feed, out, "sliding_stream", _few_partitions(spark, feed) | WINDOW_STATE))


def session_sum_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session windows on a stream: a session is emitted when the watermark passes its end. (The engine
    merges the sessions of a key in its state; a key's rows of a micro-batch are combined first.)"""
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "ts", "value"], "session_stream")
    rows = feed.stream.select("event_id", "user_id", to_event_time("ts").alias("et"), "value").withWatermark("et", OUT_OF_ORDER)
    out = (rows.groupBy("user_id", F.session_window("et", SESSION_GAP).alias("w"))
           .agg(F.count(F.lit(1)).alias("event_count"), F.sum(exact_money("value")).cast("double").alias("sum_value")))
    return _windows_out(_sink(spark, feed, out, "session_stream", _few_partitions(spark, feed) | WINDOW_STATE))


def _windows_out(done: DataFrame) -> DataFrame:
    return done.select("user_id", instant_to_ntz(F.col("w.start")).alias("window_start"),
                       instant_to_ntz(F.col("w.end")).alias("window_end"), "event_count", "sum_value")


def json_status_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous insert: a stream of JSON lines becomes a view, SQL filters it, and the passing rows
    go on as JSON lines into another folder."""
    messages = status_messages(spark, sf_dir, keep=["event_id"])
    feed = SliceFeed(messages, "event_id", PIECES, scratch_path(spark, "json_stream_landing"))
    decode_json_values(feed.stream.select("value"), STATUS_SCHEMA).createOrReplaceTempView("tw_input_stream")
    passed = spark.sql("SELECT user_id, page_id, status FROM tw_input_stream WHERE status = 'success'")
    out = scratch_path(spark, "json_stream_out")
    sink = rows_to_json(passed, ["user_id", "page_id", "status"]).writeStream.format("text").option("path", out)
    feed.drain(sink, scratch_path(spark, "json_stream_ckpt"))
    return decode_json_values(read_text_lines(spark, out), STATUS_SCHEMA)


def count_tumbling_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "value"], "count_tumbling_stream")
    return _carried(spark, feed, count_window_step("user_id", "event_id", "value", COUNT_SIZE, COUNT_SIZE, exact_money), _COUNT_WINDOW,
                    "count_tumbling_stream")


def split_even_odd_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side outputs of a stream: each micro-batch is tagged once, kept in
    memory/disk while both outputs are written, then released."""
    from pyspark import StorageLevel

    keys = read_table(spark, sf_dir, "orders", ["o_orderkey"]).withColumnRenamed("o_orderkey", "value")
    feed = SliceFeed(keys, "value", PIECES, scratch_path(spark, "split_stream_landing"))
    outs = {tag: scratch_path(spark, f"split_stream_{tag}") for tag in ("even", "odd")}

    def write_sides(batch: DataFrame, epoch_id: int) -> None:
        tagged = batch.withColumn("tag", even_odd_tag("value")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for tag, path in outs.items():
                (tagged.where(F.col("tag") == tag).select("value")
                 .withColumn("epoch", F.lit(int(epoch_id)).cast("long"))
                 .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch")
                 .parquet(path))
        finally:
            tagged.unpersist()

    feed.drain(feed.stream.writeStream.foreachBatch(write_sides), scratch_path(spark, "split_stream_ckpt"))
    return union_all(*[spark.read.parquet(p).select("value", F.lit(t).alias("tag")) for t, p in outs.items()])


def order_timeout_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases wait one hour for a click of the same user (map state + event-time timers)."""
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "ts", "event_type"], "order_timeout_stream")
    # every event moves the watermark; only purchases and clicks reach the state
    rows = (feed.stream.select("user_id", "event_type", F.coalesce("event_id", F.lit(NO_ID)).alias("order_id"),
                       F.floor(epoch_micros("ts") / 1000).cast("long").alias("ms"),
                       F.timestamp_micros(epoch_micros("ts")).alias("et"))
            .withWatermark("et", TIMER_WATERMARK)
            # one predicate that reads the event time: Catalyst keeps it above the
            # watermark (a filter without it is pushed below and the watermark
            # would only see purchases and clicks)
            .where(F.coalesce(F.col("event_type").isin("purchase", "click") & F.col("et").isNotNull(),
                              F.lit(False)))
            .select("user_id",
                    F.when(F.col("event_type") == "purchase", F.lit("order")).otherwise(F.lit("review")).alias("kind"),
                    "order_id", "ms", "et"))
    out = rows.groupBy("user_id").transformWithStateInPandas(
        OrderTimeoutProcessor("user_id", duration_micros(TIMEOUT) // 1000),
        "order_id long, user_id long, order_ms long, handled_ms long, status string",
        "Append", "EventTime")
    return _with_id(_sink(spark, feed, out, "order_timeout_stream"), "order_id")


def order_timeout_drain_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal timers: every event is an order with a timer one hour later, and
    each timer hands all pending orders of the user that arrived before it."""
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "ts"], "drain_stream")
    rows = (feed.stream.select("user_id", F.lit("order").alias("kind"), F.coalesce("event_id", F.lit(NO_ID)).alias("order_id"),
                       F.floor(epoch_micros("ts") / 1000).cast("long").alias("ms"),
                       F.timestamp_micros(epoch_micros("ts")).alias("et"))
            .withWatermark("et", TIMER_WATERMARK))
    out = rows.groupBy("user_id").transformWithStateInPandas(
        OrderTimeoutProcessor("user_id", duration_micros(TIMEOUT) // 1000, drain_all=True),
        "order_id long, user_id long, order_ms long, handled_ms long, status string",
        "Append", "EventTime")
    done = _with_id(_sink(spark, feed, out, "drain_stream"), "order_id")
    status = F.when(char_code_parity(F.col("order_id"), integral=True) == 0, F.lit("reviewed")) \
        .otherwise(F.lit("auto_good_review"))
    return done.select("order_id", "user_id", "order_ms", "handled_ms", status.alias("status"))


def retract_changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id"], "changelog_stream")
    return _carried(spark, feed, changelog_step("user_id", "event_id"),
                    "event_id long, change_seq int, op boolean, user_id long, frequency long", "changelog_stream")


def tumble_sql_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL group window over a streaming temp view; append mode emits a window
    once the watermark (max event time - bound) passes its end."""
    feed = _landed_events(spark, sf_dir, ["event_id", "user_id", "ts", "value"], "tumble_sql_stream")
    (feed.stream.select("user_id", to_event_time("ts").alias("rowtime"), "value")
     .withWatermark("rowtime", SQL_BOUND).createOrReplaceTempView("tw_t_order_stream"))
    out = spark.sql(f"""
        SELECT user_id, count(*) AS order_count, max(value) AS max_value, min(value) AS min_value
        FROM tw_t_order_stream GROUP BY user_id, window(rowtime, '{SQL_TUMBLE}')""")
    return _sink(spark, feed, out, "tumble_sql_stream")


def sales_dashboard_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live dashboard: stage 1 is a streaming aggregate per (category, day)
    (complete mode: its state is categories x days rows); stage 2 runs per
    micro-batch in ``foreachBatch`` on the open day (the day of the newest sale):
    rounded category totals, their rounded sum and the top 3, stamped with the
    newest sale time. Each batch writes its own ``epoch`` partition (idempotent).
    One arrival slice is one epoch."""
    feed = _landed_events(spark, sf_dir, ["event_id", "event_type", "ts", "value"], "dashboard_stream")
    totals = (feed.stream.select(F.col("event_type").alias("category"), to_event_time("ts").alias("et"),
                         F.col("value").alias("price"))
              .groupBy("category", F.window("et", "1 day", "1 day", DAY_START).alias("day"))
              .agg(F.sum(exact_money("price")).alias("amount"), F.max("et").alias("last_et")))
    out_path = scratch_path(spark, "dashboard_stream_out")

    def tick(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()                          # small: categories x days; the state is read once
        try:
            latest = batch.agg(F.max(F.unix_micros("last_et"))).first()[0]   # one scalar per batch
            if latest is None:
                return
            now = F.lit(int(latest))
            open_day = batch.where((F.unix_micros("day.start") <= now) & (F.unix_micros("day.end") > now))
            clock = clock_text(from_epoch_micros(now))
            stage1 = open_day.select("category", clock.alias("date_time"),
                                     round_half_up(F.col("amount"), 2).cast("double").alias("total_price"))
            lines = dashboard_lines(stage1)
            (lines.withColumn("epoch", F.lit(int(epoch_id)).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch")
             .parquet(out_path))
        finally:
            batch.unpersist()

    feed.closing = None                                  # every slice is a tick; there is no last one
    feed.drain(totals.writeStream.outputMode("complete").foreachBatch(tick),
               scratch_path(spark, "dashboard_stream_ckpt"))
    return spark.read.parquet(out_path).select(F.col("epoch").cast("long").alias("epoch"), "date_time", "line")


def _day_totals(feed: SliceFeed) -> DataFrame:
    """Stage 1 of the dashboard as a stream: (category, tick, total) at every tick of every day, by a recurring timer. ``tick`` is the event
    time that the next stage goes by."""
    price = exact_money("value")
    rows = (feed.stream.select("event_id", F.col("event_type").alias("category"), to_event_time("ts").alias("et"),
                               F.floor(price).cast("long").alias("whole"), ((price - F.floor(price)) * UNITS).cast("long").alias("nano"))
            .withWatermark("et", TIMER_WATERMARK)
            # without the closing row: one predicate that reads the event time and can't be split, so it stays above the watermark
            .where(F.when(~F.col("event_id").eqNullSafe(F.lit(feed.closing_order)), F.col("et")).isNotNull())
            .select("category", (F.floor(F.unix_millis("et") / TICK_MS) * TICK_MS + TICK_MS).cast("long").alias("tick_ms"),
                    F.coalesce("whole", F.lit(0)).alias("whole"), F.coalesce("nano", F.lit(0)).alias("nano"), "et"))
    out = rows.groupBy("category").transformWithStateInPandas(
        DayTotalProcessor("category", TICK_MS, duration_micros("1 day") // 1000, duration_micros(DAY_START) // 1000),
        "category string, tick timestamp, whole long, nano long", "Append", "EventTime", eventTimeColumnName="tick")
    total = F.col("whole").cast("decimal(27,9)") + (F.col("nano").cast("decimal(19,0)") / UNITS).cast("decimal(10,9)")
    return out.select("category", "tick", round_half_up(total, 2).alias("total"))


def running_day_total_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _landed_events(spark, sf_dir, ["event_id", "event_type", "ts", "value"], "day_total_stream")
    done = _sink(spark, feed, _day_totals(feed), "day_total_stream")
    at = instant_to_ntz("tick")
    return done.select("category", at.alias("tick"), clock_text(at).alias("date_time"), F.col("total").cast("double").alias("total_price"))


def dashboard_two_stage_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two keyed stages in one query: the totals per category and tick go on, with their watermark, to a sum per tick. Append
    mode: a tick is emitted once, when the watermark has passed it, and both states hold open days and ticks only."""
    feed = _landed_events(spark, sf_dir, ["event_id", "event_type", "ts", "value"], "two_stage_stream")
    out = _day_totals(feed).groupBy("tick").agg(F.count(F.lit(1)).alias("category_count"), F.sum("total").alias("total"))
    done = _sink(spark, feed, out, "two_stage_stream")
    return done.select(clock_text(instant_to_ntz("tick")).alias("date_time"), "category_count",
                       round_half_up("total", 2).cast("double").alias("total_price"))


def union_live(spark: SparkSession, sf_dir: str, policy: str = "min", behind: int = 1) -> DataFrame:
    """Two live sources of different speed in one query: purchases arrive a slice later than the other events. The watermark
    of the union is that of the slower source (policy ``min``), so a window waits for both."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "ts", "value"])
    slow = F.coalesce(F.col("event_type") == "purchase", F.lit(False))
    feeds = [SliceFeed(part.select("event_id", "user_id", "ts", "value"), "event_id", LIVE_PIECES, scratch_path(spark, f"live_{i}_landing"), ("ts", CLOSING))
             for i, part in enumerate([ev.where(~slow), ev.where(slow)])]
    sides = [f.stream.select("event_id", "user_id", to_event_time("ts").alias("et"), "value").withWatermark("et", OUT_OF_ORDER) for f in feeds]
    both = sides[0].unionByName(sides[1])
    out = (both.groupBy("user_id", F.window("et", TUMBLE).alias("w"))
           .agg(F.count(F.lit(1)).alias("event_count"), F.sum(exact_money("value")).cast("double").alias("sum_value")))
    use_rocksdb_state(spark)
    path, key = scratch_path(spark, "live_sink"), "spark.sql.streaming.multipleWatermarkPolicy"
    old = spark.conf.get(key, None)
    spark.conf.set(key, policy)
    try:
        drain_together(feeds, out.writeStream.format("parquet").outputMode("append").option("path", path), scratch_path(spark, "live_ckpt"), behind)
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    return _windows_out(spark.read.schema(out.schema).parquet(path))


_DEC = "CAST(value AS DECIMAL(18,2))"
_BUCKET = f"time_bucket(INTERVAL '{SQL_TUMBLE}', ts, TIMESTAMP '1970-01-01 00:00:00')"

ORACLE = {
    "running_max_stream": """SELECT event_id, user_id, value,
        max(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS max_value
        FROM events""",
    "count_sliding_stream": f"""WITH r AS (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
                 count(*) OVER (PARTITION BY user_id ORDER BY event_id
                                ROWS BETWEEN {COUNT_SIZE - 1} PRECEDING AND CURRENT ROW) AS n,
                 sum({_DEC}) OVER (PARTITION BY user_id ORDER BY event_id
                                   ROWS BETWEEN {COUNT_SIZE - 1} PRECEDING AND CURRENT ROW) AS s
          FROM events)
        SELECT user_id, CAST(rn // {COUNT_SLIDE} AS BIGINT) AS window_index, n AS event_count,
               CAST(s AS DOUBLE) AS sum_value, event_id AS last_event_id
        FROM r WHERE rn % {COUNT_SLIDE} = 0""",
    "order_timeout_stream": f"""WITH o AS (SELECT event_id, user_id, ts, epoch_us(ts) // 1000 AS ms
                   FROM events WHERE event_type = 'purchase'),
        r AS (SELECT user_id, ts FROM events WHERE event_type = 'click')
        SELECT event_id AS order_id, user_id, ms AS order_ms, ms + {duration_micros(TIMEOUT) // 1000} AS handled_ms,
               CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.user_id = o.user_id AND r.ts > o.ts
                                 AND r.ts <= o.ts + INTERVAL '{TIMEOUT}')
                    THEN 'reviewed' ELSE 'auto_good_review' END AS status
        FROM o""",
}

ORACLE["retract_changelog_stream"] = """
  WITH r AS (SELECT event_id, user_id,
                    count(*) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS c
             FROM events)
  SELECT * FROM (
    SELECT event_id, 0 AS change_seq, false AS op, user_id, c - 1 AS frequency FROM r WHERE c > 1
    UNION ALL
    SELECT event_id, 1 AS change_seq, true AS op, user_id, c AS frequency FROM r)"""

ORACLE["tumble_sql_stream"] = f"""
  SELECT user_id, order_count, max_value, min_value FROM (
    SELECT user_id, {_BUCKET} AS ws, count(*) AS order_count, max(value) AS max_value, min(value) AS min_value
    FROM events GROUP BY user_id, {_BUCKET})
  """

ORACLE["order_timeout_drain_stream"] = f"""
  WITH o AS (SELECT event_id, user_id, epoch_us(ts) // 1000 AS ms FROM events),
  d AS (SELECT event_id AS order_id, user_id, ms AS order_ms,
               min(ms) OVER (PARTITION BY user_id ORDER BY ms RANGE BETWEEN 3599999 PRECEDING AND CURRENT ROW)
               + 3600000 AS handled_ms,
               CASE WHEN list_sum(list_transform(string_split(CAST(event_id AS VARCHAR), ''),
                                                 lambda ch: unicode(ch))) % 2 = 0
                    THEN 'reviewed' ELSE 'auto_good_review' END AS status
        FROM o)
  SELECT d.* FROM d"""

from tidewater.plans.dashboard import (ITEM_CLOSE, ITEM_OPEN, ITEM_TOTAL, LINE_TIME,  # noqa: E402
                                       LINE_TOTAL)

# Each arrival slice is one landed file and so one micro-batch (epoch).
ORACLE["sales_dashboard_stream"] = f"""
  WITH a AS (SELECT event_id, event_type AS category, ts, value FROM events),
  b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM a),
  p AS (SELECT a.*, (event_id - lo) // ((hi - lo) // {PIECES} + 1) AS piece FROM a, b),
  ep AS (SELECT DISTINCT piece AS epoch FROM p),
  clk AS (SELECT ep.epoch, max(p.ts) AS mx FROM ep JOIN p ON p.piece <= ep.epoch GROUP BY ep.epoch),
  dy AS (SELECT epoch, mx, time_bucket(INTERVAL '1 day', mx, TIMESTAMP '1970-01-01 16:00:00') AS ds FROM clk),
  s1 AS (SELECT d.epoch, strftime(d.mx, '%Y-%m-%d %H:%M:%S') AS date_time, p.category,
                CAST(round(sum(CAST(p.value AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_price
         FROM dy d JOIN p ON p.piece <= d.epoch AND p.ts >= d.ds AND p.ts < d.ds + INTERVAL '1 day'
         GROUP BY d.epoch, d.mx, p.category),
  t AS (SELECT epoch, date_time, CAST(round(sum(CAST(total_price AS DECIMAL(18,2))), 2) AS DOUBLE) AS total_price
        FROM s1 GROUP BY epoch, date_time),
  k AS (SELECT *, row_number() OVER (PARTITION BY epoch ORDER BY total_price DESC, category) AS rank FROM s1),
  items AS (SELECT epoch, string_agg('{ITEM_OPEN}' || category || '{ITEM_TOTAL}' || CAST(total_price AS VARCHAR)
                                     || '{ITEM_CLOSE}', ',' || chr(10) ORDER BY rank) AS txt
            FROM k WHERE rank <= 3 GROUP BY epoch)
  SELECT t.epoch, t.date_time, '{LINE_TIME}' || t.date_time || '{LINE_TOTAL}' || CAST(t.total_price AS VARCHAR)
         || ' top3:' || chr(10) || items.txt AS line
  FROM t JOIN items ON t.epoch = items.epoch"""

ORACLE["count_tumbling_stream"] = f"""WITH r AS (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
        SELECT user_id, CAST((rn - 1) // {COUNT_SIZE} + 1 AS BIGINT) AS window_index, count(*) AS event_count,
               CAST(sum({_DEC}) AS DOUBLE) AS sum_value, max(event_id) AS last_event_id
        FROM r GROUP BY user_id, (rn - 1) // {COUNT_SIZE} HAVING count(*) = {COUNT_SIZE}"""

ORACLE["split_even_odd_stream"] = """SELECT o_orderkey AS value,
        CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS tag FROM orders"""

_LB = duration_micros(LATE_BOUND)
_LA = duration_micros(LATE_ALLOWED)
ORACLE["late_refires_stream"] = f"""
  WITH a AS (SELECT event_id, user_id, ts, value, epoch_us(ts) AS us,
                    event_id + (event_id * {ARRIVAL_MULT}) % {LATE_SPREAD} AS arrival FROM events),
  b AS (SELECT min(arrival) AS lo, max(arrival) AS hi FROM a),
  p AS (SELECT a.*, (arrival - lo) // ((hi - lo) // {LATE_PIECES} + 1) AS piece FROM a, b),
  pm AS (SELECT piece, max(us) AS mx FROM p GROUP BY piece),
  wp AS (SELECT piece, max(mx) OVER (ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mxprev
         FROM pm),
  c AS (SELECT p.*, epoch_us(time_bucket(INTERVAL '{LATE_WINDOW}', ts, TIMESTAMP '1970-01-01 00:00:00'))
                    + {duration_micros(LATE_WINDOW)} AS e, wp.mxprev
        FROM p JOIN wp ON p.piece = wp.piece),
  k AS (SELECT *, CASE WHEN mxprev IS NULL OR mxprev < e + {_LB} THEN 'on_time'
                       WHEN mxprev < e + {_LB + _LA} THEN 'late_accepted' ELSE 'late_dropped' END AS cls FROM c),
  o AS (SELECT user_id, e, count(*) AS n, sum(CAST(value AS DECIMAL(27,9))) AS s
        FROM k WHERE cls = 'on_time' GROUP BY user_id, e),
  l AS (SELECT user_id, e,
               row_number() OVER (PARTITION BY user_id, e ORDER BY arrival, event_id) AS firing,
               sum(CAST(value AS DECIMAL(27,9))) OVER (PARTITION BY user_id, e ORDER BY arrival, event_id
                                                       ROWS UNBOUNDED PRECEDING) AS ls
        FROM k WHERE cls = 'late_accepted')
  SELECT user_id, make_timestamp(e - {duration_micros(LATE_WINDOW)}) AS window_start, make_timestamp(e) AS window_end,
         CAST(0 AS BIGINT) AS firing, n AS event_count, CAST(s AS DOUBLE) AS sum_value
  FROM o
  UNION ALL
  SELECT l.user_id, make_timestamp(l.e - {duration_micros(LATE_WINDOW)}), make_timestamp(l.e), l.firing,
         coalesce(o.n, 0) + l.firing, CAST(coalesce(o.s + l.ls, o.s, l.ls) AS DOUBLE)
  FROM l LEFT JOIN o ON l.user_id IS NOT DISTINCT FROM o.user_id AND l.e = o.e"""

_LATE_CLASSES = ORACLE["late_refires_stream"][:ORACLE["late_refires_stream"].index("  o AS (")].rstrip().rstrip(",")
ORACLE["late_side_output_stream"] = _LATE_CLASSES + """
  SELECT event_id, user_id, make_timestamp(e) AS window_end, value FROM k WHERE cls = 'late_dropped'"""
ORACLE["sliding_sum_stream"] = BATCH_ORACLE["sliding_sum"]
ORACLE["session_sum_stream"] = BATCH_ORACLE["session_sum"]
ORACLE["running_day_total_stream"] = DASHBOARD_ORACLE["running_day_total"]
ORACLE["dashboard_two_stage_stream"] = DASHBOARD_ORACLE["sales_dashboard"]
ORACLE["union_live"] = BATCH_ORACLE["tumbling_sum"]
ORACLE["json_status_stream"] = TEXT_ORACLE["json_status_filter"]

QUERIES = {
    "late_refires_stream": late_refires_stream,
    "late_side_output_stream": late_side_output_stream,
    "sliding_sum_stream": sliding_sum_stream,
    "session_sum_stream": session_sum_stream,
    "running_day_total_stream": running_day_total_stream,
    "dashboard_two_stage_stream": dashboard_two_stage_stream,
    "union_live": union_live,
    "json_status_stream": json_status_stream,
    "count_tumbling_stream": count_tumbling_stream,
    "split_even_odd_stream": split_even_odd_stream,
    "order_timeout_drain_stream": order_timeout_drain_stream,
    "sales_dashboard_stream": sales_dashboard_stream,
    "retract_changelog_stream": retract_changelog_stream,
    "tumble_sql_stream": tumble_sql_stream,
    "running_max_stream": running_max_stream,
    "count_sliding_stream": count_sliding_stream,
    "order_timeout_stream": order_timeout_stream,
}
