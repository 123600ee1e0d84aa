"""Streaming guarantees: restart without loss or duplicates, idempotent epochs,
the live dashboard's last tick equal to a direct computation."""

import pytest
from pyspark.sql import functions as F

from tidewater.plans.check import compare, duck_connection
from tidewater.plans.registry import ORACLE, QUERIES
from tidewater.plans.relational import resumable_ingest
from tidewater.session import scratch_path
from tidewater.sinks.upsert import UpsertLog
from tidewater.streaming.jobs import sales_dashboard_stream

from conftest import SF_SMALL


def test_restarted_ingest_is_exactly_once(spark):
    out = resumable_ingest(spark, SF_SMALL)
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert out.count() == n
    assert out.select("event_id").distinct().count() == n


def test_upsert_epoch_retry_replaces_only_itself(spark):
    log = UpsertLog(spark, scratch_path(spark, "upsert_test"), "word", "frequency")
    b0 = spark.createDataFrame([("a", 1), ("b", 1)], "word string, frequency long")
    b1 = spark.createDataFrame([("a", 2)], "word string, frequency long")
    log.write_batch(b0, 0)
    log.write_batch(b1, 1)
    log.write_batch(b1, 1)  # retried epoch
    assert sorted(map(tuple, log.current().collect())) == [("a", 2), ("b", 1)]
    assert spark.read.parquet(log.path).count() == 3


def test_dashboard_stream_last_tick(spark):
    out = sales_dashboard_stream(spark, SF_SMALL)
    last = out.orderBy(F.col("epoch").desc()).first()
    con = duck_connection(SF_SMALL)
    mx = con.execute("SELECT max(ts) FROM events").fetchone()[0]
    day_start = con.execute(
        "SELECT time_bucket(INTERVAL '1 day', max(ts), TIMESTAMP '1970-01-01 16:00:00') FROM events").fetchone()[0]
    rows = con.execute(
        "SELECT event_type, CAST(round(sum(CAST(value AS DECIMAL(18,2))), 2) AS DOUBLE) AS s FROM events "
        "WHERE ts >= ? GROUP BY 1 ORDER BY s DESC, event_type", [day_start]).fetchall()
    total = round(sum(round(s, 2) for _, s in rows), 2)
    assert last.date_time == mx.strftime("%Y-%m-%d %H:%M:%S")
    assert f"总价 : {total}" in last.line or f"总价 : {total:.1f}" in last.line
    for cat, _ in rows[:3]:
        assert f"分类：{cat} " in last.line


def test_state_processors_run_without_the_package_on_worker_path(tmp_path):
    """A plain session started outside the repo: Python workers cannot import
    the package, so the processors must travel with the query."""
    import subprocess
    import sys

    from conftest import ROOT
    script = tmp_path / "run.py"
    script.write_text(
        "import sys\n"
        f"sys.path.insert(0, {ROOT!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
        ".config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "from tidewater.plans.registry import QUERIES\n"
        "for name in ('order_timeout_stream', 'running_max_stream', 'running_day_total_stream', 'polled_customers'):\n"
        f"    print('ROWS', name, QUERIES[name](spark, {SF_SMALL!r}).count())\n")
    out = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), capture_output=True, text=True,
                         timeout=600)
    assert "ROWS running_max_stream 1000" in out.stdout and "ROWS polled_customers 600" in out.stdout, out.stderr[-2000:]


STREAMS = ["event_time_tumbling", "tumble_sql_stream", "order_timeout_stream", "order_timeout_drain_stream", "running_max_stream",
           "count_tumbling_stream", "count_sliding_stream", "retract_changelog_stream", "sales_dashboard_stream",
           "late_refires_stream", "sliding_sum_stream", "session_sum_stream", "running_day_total_stream", "union_live"]


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """The same events in eight files, in no particular order among them."""
    folder = tmp_path_factory.mktemp("many")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").repartition(8, "event_id").write.parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", STREAMS)
def test_streams_do_not_depend_on_the_number_of_files(spark, many_files, name):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        assert spark.read.parquet(f"{many_files}/events.parquet").rdd.getNumPartitions() >= 8
        res = compare(spark, many_files, name, QUERIES[name], ORACLE[name], duck_connection(SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert res["status"] == "match", res


def test_review_that_reaches_the_stream_before_its_order(spark, tmp_path):
    """The review's row arrives in an earlier slice than the order it answers."""
    rows = [(1, 7, 100.0, "click"), (2, 8, 0.0, "view"), (3, 7, 90.0, "purchase"), (4, 8, 95.0, "purchase")]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, s double, event_type string")
    ev = ev.select("event_id", "user_id", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)").alias("ts"), "event_type")
    ev.write.parquet(f"{tmp_path}/events.parquet")
    got = {r.order_id: r.status for r in QUERIES["order_timeout_stream"](spark, str(tmp_path)).collect()}
    assert got == {3: "reviewed", 4: "auto_good_review"}


@pytest.mark.parametrize("name", ["sliding_sum_stream", "session_sum_stream"])
def test_streams_count_events_with_a_null_value(spark, tmp_path, name):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    ev.withColumn("value", F.when(F.col("event_id") % 5 != 0, F.col("value"))).write.parquet(f"{tmp_path}/events.parquet")
    con = duck_connection(SF_SMALL)
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    res = compare(spark, str(tmp_path), name, QUERIES[name], ORACLE[name], con)
    assert res["status"] == "match", res


def test_word_stream_holds_documents_without_an_id(spark, tmp_path):
    rows = [(1, "a b"), (2, "a"), (None, "a c"), (None, "c"), (-3, "b")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.word: r.frequency for r in QUERIES["word_count_stream"](spark, str(tmp_path)).collect()}
    assert got == {"a": 3, "b": 2, "c": 2}
