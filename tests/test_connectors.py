"""Readers and writers: text folders, gzip by suffix, recursive lookup, one-file
sink, Kafka-style record decoding, JSON rows, poll tagging."""

import gzip
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.sinks.kafka import to_kafka_records
from tidewater.sinks.text import write_text
from tidewater.sources.jdbc import tag_poll
from tidewater.sources.kafka import decode_json_values
from tidewater.sources.tables import stream_table
from tidewater.sources.text import read_text_lines


def test_text_file_folder_and_gzip(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text("x y\nz\n")
    with gzip.open(tmp_path / "d" / "b.txt.gz", "wt") as f:
        f.write("g1\ng2\n")
    (tmp_path / "d" / "sub").mkdir()
    (tmp_path / "d" / "sub" / "c.txt").write_text("deep\n")
    one = read_text_lines(spark, str(tmp_path / "d" / "a.txt"))
    assert [r.value for r in one.collect()] == ["x y", "z"]
    flat = sorted(r.value for r in read_text_lines(spark, str(tmp_path / "d")).collect())
    assert flat == ["g1", "g2", "x y", "z"]                      # not recursive by default
    deep = sorted(r.value for r in read_text_lines(spark, str(tmp_path / "d"), recursive=True).collect())
    assert deep == ["deep", "g1", "g2", "x y", "z"]


def test_text_sink_one_file_or_one_per_task(spark, tmp_path):
    df = spark.range(1, 11).repartition(3).select(F.col("id").cast("string").alias("value"))
    write_text(df, str(tmp_path / "many"))
    write_text(df, str(tmp_path / "one"), single_file=True)
    parts = lambda p: [f for f in os.listdir(p) if f.startswith("part-")]
    assert len(parts(tmp_path / "one")) == 1
    assert len(parts(tmp_path / "many")) == 3
    back = sorted(int(r.value) for r in read_text_lines(spark, str(tmp_path / "one")).collect())
    assert back == list(range(1, 11))


def test_kafka_records_roundtrip(spark):
    rows = spark.createDataFrame([(1, "toney", 19), (2, None, 20)], "id int, name string, age int")
    recs = to_kafka_records(rows)
    assert sorted(r.value for r in recs.collect()) == ['{"age":19,"id":1,"name":"toney"}', '{"age":20,"id":2}']
    binary = recs.select(F.encode("value", "UTF-8").alias("value"))       # what the broker holds
    text = binary.select(F.col("value").cast("string").alias("value"))
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("age", T.IntegerType())])
    back = sorted(tuple(r) for r in decode_json_values(text, schema).collect())
    assert back == [(1, "toney", 19), (2, None, 20)]


def test_poll_tags_every_row(spark):
    snap = spark.createDataFrame([(1, "jack", 18), (2, "tom", 19), (3, "rose", 20)], "id int, name string, age int")
    polls = tag_poll(snap, 0).unionByName(tag_poll(snap, 1))
    assert polls.groupBy("poll_id").count().orderBy("poll_id").collect()[1]["count"] == 3
    assert polls.count() == 6


def test_one_table_as_a_file_stream(spark, tmp_path):
    from conftest import SF_SMALL
    stream = stream_table(spark, SF_SMALL, "events")
    q = (stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt"))
         .trigger(availableNow=True).start(str(tmp_path / "out")))
    q.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert set(out.columns) == {"event_id", "ts", "user_id", "event_type", "value", "props"}


def test_lines_end_with_newline_only(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"a\rb\r\nc\n\r\n")
    from tidewater.functions.text import text_lines_of
    from tidewater.sources.text import read_text_lines
    assert [r.value for r in read_text_lines(spark, str(tmp_path)).collect()] == ["a\rb", "c", ""]
    df = spark.createDataFrame([("a\rb\r\nc\n\r",)], "t string")
    assert df.select(text_lines_of("t").alias("l")).first().l == ["a\rb", "c", ""]
