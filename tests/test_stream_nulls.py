"""Streams equal their batch twins on events with null values, keys and ids, and values of nine places; texts may be null too."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.plans.check import compare, duck_connection
from tidewater.plans.registry import ORACLE, QUERIES

SCHEMA = "event_id long, secs double, user_id long, event_type string, value double, props string"


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    draw = random.Random(12)
    rows = []
    for i in range(400):
        value = None if draw.random() < 0.15 else draw.choice([4e-7, 1e-9, 123.456789012, round(draw.uniform(0, 400), 9)])
        rows.append((None if i == 3 else i, 900.0 * i + draw.randrange(800), None if draw.random() < 0.1 else draw.choice([0, 0, 0, 1, 2, 3, 4]),
                     None if draw.random() < 0.05 else draw.choice(["click", "purchase", "view", "error"]), value, '{"k": 1}'))
    rows += [(i, 900.0 * i, 77, "view", None, None) for i in range(400, 406)]           # a user without any value
    folder = tmp_path_factory.mktemp("nulls")
    ev = spark.createDataFrame(rows, SCHEMA)
    ev = ev.withColumn("ts", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, secs)")).drop("secs")
    ev.coalesce(2).write.parquet(f"{folder}/events.parquet")
    texts = [(1, "a b\nc"), (2, None), (None, "a only"), (None, None), (3, ""), (4, "b  b "), (5, "\n\n")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def bag(df, columns=None):
    columns = columns or sorted(df.columns)
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in columns)) for r in df.collect())


TWINS = [("running_max_stream", "running_max"), ("count_tumbling_stream", "count_tumbling"), ("count_sliding_stream", "count_sliding"),
         ("retract_changelog_stream", "retract_changelog"), ("sliding_sum_stream", "sliding_sum"), ("session_sum_stream", "session_sum"),
         ("event_time_tumbling", "tumbling_sum"), ("tumble_sql_stream", "tumble_sql"), ("running_day_total_stream", "running_day_total"),
         ("dashboard_two_stage_stream", "sales_dashboard"), ("union_live", "tumbling_sum"), ("order_timeout_drain_stream", "order_timeout_drain"),
         ("word_count_stream", "word_count"), ("kv_upsert", "word_count")]


@pytest.mark.parametrize("stream,batch", TWINS)
def test_stream_equals_batch(spark, awkward, stream, batch):
    got, want = QUERIES[stream](spark, awkward), QUERIES[batch](spark, awkward)
    assert sorted(got.columns) == sorted(want.columns)
    got, want = bag(got), bag(want)
    assert want and got == want, (list((got - want).items())[:5], list((want - got).items())[:5])


def test_order_timeouts(spark, awkward):
    stream = QUERIES["order_timeout_stream"](spark, awkward)
    batch = QUERIES["order_timeout"](spark, awkward)
    assert bag(stream, ["order_id", "user_id", "status"]) == bag(batch, ["order_id", "user_id", "status"])


@pytest.mark.parametrize("name", ["late_refires_stream", "late_side_output_stream"])
def test_late_streams(spark, awkward, tmp_path, name):
    """Against SQL, which knows no slice for a row without an id."""
    spark.read.parquet(f"{awkward}/events.parquet").where("event_id is not null").write.parquet(f"{tmp_path}/events.parquet")
    con = duck_connection("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    res = compare(spark, str(tmp_path), name, QUERIES[name], ORACLE[name], con)
    assert res["status"] == "match" and res["spark_rows"] > 0, res


def test_text_lines_leave_null_texts_out(spark, awkward):
    lines = [r.value for r in QUERIES["text_lines"](spark, awkward).collect()]
    assert Counter(lines) == Counter(["a b", "c", "a only", "", "b  b ", "", "", ""])


def test_values_without_a_decimal_count_as_null(spark):
    from tidewater.functions.money import exact_money

    rows = [(float("nan"),), (float("inf"),), (1e30,), (None,), (0.5,)]
    got = [r.m for r in spark.createDataFrame(rows, "v double").select(exact_money("v").alias("m")).collect()]
    assert got[:4] == [None] * 4 and float(got[4]) == 0.5


def test_lookup_default_is_for_missing_keys_only(spark):
    from tidewater.operators.enrich import lookup_join

    fact = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    dim = spark.createDataFrame([(1, "x"), (2, None)], "k long, name string")
    assert {r.k: r.name for r in lookup_join(fact, dim, "k", {"name": ""}).collect()} == {1: "x", 2: None, 3: ""}
