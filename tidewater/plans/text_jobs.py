"""Word-count family over ``documents.text`` and the text/JSON connectors.

Lines are ``\\n``-separated (what a line source returns); tokens are the Java
``split(" ")`` of each line. Every query reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.jsonfn import rows_to_json
from tidewater.functions.text import java_split, text_lines_of, tokens_of
from tidewater.operators.aggregate import count_by_key, keyed_fold
from tidewater.operators.basic import exclude_value
from tidewater.session import scratch_path
from tidewater.sinks.text import write_text
from tidewater.sinks.upsert import UpsertLog
from tidewater.sources.kafka import decode_json_values
from tidewater.sources.tables import read_table
from tidewater.sources.text import read_text_lines, stream_text_lines
from tidewater.streaming.feed import run_available_now

# Fixed value from the reference program: the token its filter removes.
FILTERED_WORD = "haha"

# Micro-batches in which the corpus is fed through the upsert sink, however many documents there are.
EPOCHS, STREAM_SLICES = 8, 4
WORD_BUCKETS = 16


def _docs(spark: SparkSession, sf_dir: str, cols=("doc_id", "text")) -> DataFrame:
    return read_table(spark, sf_dir, "documents", list(cols), spread=True)


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per token: lines are exploded first, then each line is split
    (plain code-generated expressions, no per-element lambda)."""
    lines = _docs(spark, sf_dir, ("text",)).select(F.explode(text_lines_of("text")).alias("line"))
    return lines.select(F.explode(java_split("line")).alias("word"))


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flatMap(split) -> map(word, 1) -> keyBy(word).sum: final counts."""
    return count_by_key(words(spark, sf_dir), "word")


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    return d.select("doc_id", F.posexplode(tokens_of("text")).alias("pos", "token")) \
        .select("doc_id", F.col("pos").cast("long").alias("pos"), "token")


def filter_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_key(exclude_value(words(spark, sf_dir), "word", FILTERED_WORD), "word")


def reduce_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = words(spark, sf_dir).withColumn("one", F.lit(1).cast("long"))
    return keyed_fold(pairs, ["word"], "one", "sum", "frequency")


def sql_group_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    words(spark, sf_dir).select("word", F.lit(1).cast("long").alias("frequency")) \
        .createOrReplaceTempView("tw_word_rows")
    return spark.sql("SELECT word, sum(frequency) AS frequency FROM tw_word_rows GROUP BY word")


def group_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = words(spark, sf_dir).select("word", F.lit(1).cast("long").alias("frequency"))
    return pairs.groupBy("word").agg(F.sum("frequency").alias("frequency")).where(F.col("frequency") == 2)


def line_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Literal variant: the whole line is the key, emitted once per token of it."""
    lines = _docs(spark, sf_dir, ("text",)).select(F.explode(text_lines_of("text")).alias("line"))
    per_line = lines.select("line", F.size(java_split("line")).cast("long").alias("n")).where("n > 0")
    return per_line.groupBy("line").agg(F.sum("n").alias("frequency"))


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the corpus as gzip text files, read the lines back (suffix decides codec)."""
    path = scratch_path(spark, "text_lines")
    write_text(_docs(spark, sf_dir, ("text",)), path, column="text", compression="gzip")
    return read_text_lines(spark, path)


def _event_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["user_id", "props"])
    return ev.select(F.concat_ws(",", F.col("user_id").cast("string"),
                                 F.get_json_object("props", "$.k")).alias("value"))


def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id,count`` lines written by every task to one folder, read back."""
    path = scratch_path(spark, "text_sink")
    write_text(_event_csv_lines(spark, sf_dir), path)
    return read_text_lines(spark, path)


def parse_csv_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``"9,3"`` -> ``(id string, count int)``; a bad number fails the cast (ANSI)."""
    path = scratch_path(spark, "csv_lines")
    write_text(_event_csv_lines(spark, sf_dir), path)
    parts = F.split(F.col("value"), ",")
    return read_text_lines(spark, path).select(parts[0].alias("id"), parts[1].cast("int").alias("count"))


def kafka_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-style records (binary ``value``) decoded as text, then word count."""
    lines = _docs(spark, sf_dir, ("text",)).select(F.explode(text_lines_of("text")).alias("line"))
    records = lines.select(F.encode("line", "UTF-8").alias("value"))
    decoded = records.select(F.col("value").cast("string").alias("value"))
    return count_by_key(decoded.select(F.explode(java_split("value")).alias("word")), "word")


def kv_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running word counts written batch by batch into a keyed upsert table.

    The corpus is cut into ``EPOCHS`` ranges of doc_id; each writes the new running
    totals of the words it touched (update-mode output). A word has at most one row per
    epoch, so the running window of the commonest word stays that short. The table's
    current state is the last write per word.
    """
    d = _docs(spark, sf_dir)
    lo, hi = d.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = ((hi or 0) - (lo or 0)) // EPOCHS + 1
    d = d.withColumn("epoch", F.coalesce(F.floor((F.col("doc_id") - F.lit(lo or 0)) / F.lit(width)), F.lit(0)).cast("long"))
    lines = d.select("epoch", F.explode(text_lines_of("text")).alias("line"))
    per_epoch = lines.select("epoch", F.explode(java_split("line")).alias("word")) \
        .groupBy("word", "epoch").agg(F.count(F.lit(1)).alias("n"))
    running = per_epoch.withColumn(
        "frequency", F.sum("n").over(Window.partitionBy("word").orderBy("epoch")
                                      .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    path = scratch_path(spark, "kv_upsert")
    # each epoch writes its own folder, by as many tasks as there are buckets of words
    (running.select("word", "frequency", "epoch").repartition("epoch", F.pmod(F.xxhash64("word"), F.lit(WORD_BUCKETS))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(path))
    return UpsertLog(spark, path, "word", "frequency").current()


def word_count_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live word count: a folder of text files is the line source, update-mode
    counts go through ``foreachBatch`` into the upsert table."""
    src = scratch_path(spark, "wc_stream_src")
    docs = _docs(spark, sf_dir)
    docs.limit(0).select("text").write.mode("append").text(src)      # the folder exists before the stream starts
    lines = stream_text_lines(spark, src)
    counts = lines.select(F.explode(java_split("value")).alias("word")).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("frequency"))
    table = UpsertLog(spark, scratch_path(spark, "wc_stream_table"), "word", "frequency")
    query = counts.writeStream.outputMode("update").foreachBatch(table.write_batch)
    checkpoint = scratch_path(spark, "wc_stream_ckpt")
    for i in range(STREAM_SLICES):                                   # a slice lands, the stream drains it
        mine = docs.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(STREAM_SLICES)) == i)
        mine.select("text").where("text is not null").write.mode("append").text(src)
        run_available_now(query, checkpoint)
    return table.current()


STATUS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("status", T.StringType()),
])


def status_messages(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """JSON messages with ids as JSON strings, derived from events."""
    keep = keep or []
    ev = read_table(spark, sf_dir, "events", [*keep, "user_id", "event_type", "props"])
    return ev.select(*keep, F.to_json(F.struct(
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("page_id"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("status"),
    )).alias("value"))


def json_status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic of JSON messages -> typed rows -> ``status = 'success'`` -> JSON topic.

    The topic is a folder of JSON-lines files here; with the Kafka connector the
    same transform runs on ``readStream.format('kafka')``.
    """
    topic_in = scratch_path(spark, "topic_in")
    write_text(status_messages(spark, sf_dir), topic_in)
    rows = decode_json_values(read_text_lines(spark, topic_in), STATUS_SCHEMA)
    rows.createOrReplaceTempView("tw_input_topic")
    passed = spark.sql("SELECT user_id, page_id, status FROM tw_input_topic WHERE status = 'success'")
    topic_out = scratch_path(spark, "topic_out")
    write_text(rows_to_json(passed, ["user_id", "page_id", "status"]), topic_out)
    return decode_json_values(read_text_lines(spark, topic_out), STATUS_SCHEMA)


def to_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "user_id", "event_type", "value"])
    return rows_to_json(ev, out="json")


_TOKENS_SQL = ("flatten(list_transform(string_split(text, chr(10)), lambda line: "
               "CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[] "
               "ELSE string_split(rtrim(line, ' '), ' ') END))")
_JAVA_SPLIT_SQL = ("CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[] "
                   "ELSE string_split(rtrim(line, ' '), ' ') END")
_WORDS_SQL = f"SELECT unnest({_TOKENS_SQL}) AS word FROM documents"
_WORD_COUNT_SQL = f"SELECT word, count(*) AS frequency FROM ({_WORDS_SQL}) GROUP BY word"

ORACLE = {
    "word_count": _WORD_COUNT_SQL,
    "tokenize": f"""
        SELECT doc_id, CAST(pos - 1 AS BIGINT) AS pos, token FROM (
          SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS pos
          FROM (SELECT doc_id, {_TOKENS_SQL} AS t FROM documents))""",
    "filter_words": f"SELECT word, count(*) AS frequency FROM ({_WORDS_SQL}) WHERE word <> '{FILTERED_WORD}' GROUP BY word",
    "reduce_sum": _WORD_COUNT_SQL,
    "sql_group_sum": _WORD_COUNT_SQL,
    "group_having": f"SELECT word, count(*) AS frequency FROM ({_WORDS_SQL}) GROUP BY word HAVING count(*) = 2",
    "line_token_count": f"""
        SELECT line, CAST(sum(len({_JAVA_SPLIT_SQL})) AS BIGINT) AS frequency
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
        WHERE len({_JAVA_SPLIT_SQL}) > 0 GROUP BY line""",
    "text_lines": "SELECT unnest(string_split(text, chr(10))) AS value FROM documents WHERE text IS NOT NULL",
    "text_sink": "SELECT concat_ws(',', CAST(user_id AS VARCHAR), json_extract_string(props, '$.k')) AS value FROM events",
    "parse_csv_counts": """SELECT CAST(user_id AS VARCHAR) AS id,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS "count" FROM events""",
    "kafka_text": f"""SELECT word, count(*) AS frequency FROM (
        SELECT unnest({_JAVA_SPLIT_SQL}) AS word
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY word""",
    "kv_upsert": _WORD_COUNT_SQL,
    "word_count_stream": _WORD_COUNT_SQL,
    "json_status_filter": """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS page_id,
        'success' AS status FROM events WHERE event_type <> 'error'""",
    "to_json_rows": """SELECT to_json(struct_pack(event_id := event_id, event_type := event_type,
        user_id := user_id, value := value))::VARCHAR AS json FROM events""",
}

QUERIES = {
    "word_count": word_count,
    "tokenize": tokenize,
    "filter_words": filter_words,
    "reduce_sum": reduce_sum,
    "sql_group_sum": sql_group_sum,
    "group_having": group_having,
    "line_token_count": line_token_count,
    "text_lines": text_lines,
    "text_sink": text_sink,
    "parse_csv_counts": parse_csv_counts,
    "kafka_text": kafka_text,
    "kv_upsert": kv_upsert,
    "word_count_stream": word_count_stream,
    "json_status_filter": json_status_filter,
    "to_json_rows": to_json_rows,
}
