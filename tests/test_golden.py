
from pyspark.sql import functions as F

from tidewater.operators.aggregate import max_row_by_key, observed_count, partition_sizes, running_by_key
from tidewater.operators.basic import connect_map, even_odd_tag, split_by_tag, union_all
from tidewater.operators.changelog import filter_changelog, retract_changelog
from tidewater.operators.enrich import dedupe_last, lookup_join
from tidewater.operators.windows import count_windows, tumbling
from tidewater.sources.inline import inclusive_range, inline_rows


def test_sql_union_of_filtered_views(spark):
    a = inline_rows(spark, [(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], "userId long, product string, amount int")
    b = inline_rows(spark, [(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], "userId long, product string, amount int")
    a.createOrReplaceTempView("order_a")
    b.createOrReplaceTempView("order_b")
    got = spark.sql("SELECT * FROM order_a WHERE amount > 2 UNION ALL SELECT * FROM order_b WHERE amount < 2")
    assert sorted(map(tuple, got.collect())) == [(1, "beer", 3), (1, "diaper", 4), (4, "beer", 1)]


def _wc(spark):
    return inline_rows(spark, [(0, "Hello", 1), (1, "World", 1), (2, "Hello", 1)], "seq long, word string, frequency long")


def test_sql_word_count_having_and_changelog(spark):
    wc = _wc(spark)
    wc.createOrReplaceTempView("WordCount")
    got = spark.sql("select word, sum(frequency) as frequency from WordCount group by word")
    assert sorted(map(tuple, got.collect())) == [("Hello", 2), ("World", 1)]
    having = wc.groupBy("word").agg(F.sum("frequency").alias("frequency")).where("frequency = 2")
    assert [tuple(r) for r in having.collect()] == [("Hello", 2)]
    log = retract_changelog(wc, "word", "seq").orderBy("seq", "change_seq")
    assert [(r.op, r.word, r.frequency) for r in log.collect()] == [
        (True, "Hello", 1), (True, "World", 1), (False, "Hello", 1), (True, "Hello", 2)]
    having_log = filter_changelog(retract_changelog(wc, "word", "seq"), "frequency", 2)
    assert [(r.op, r.word, r.frequency) for r in having_log.collect()] == [(True, "Hello", 2)]


CITIES = [(0, "北京", 1), (1, "上海", 2), (2, "北京", 6), (3, "上海", 8), (4, "北京", 3), (5, "上海", 4)]


def test_keyed_value_state_running_max_and_max_by(spark):
    df = inline_rows(spark, CITIES, "seq long, city string, value long")
    got = running_by_key(df, "city", "seq", "value", "max", "max_value", chunk_width=2).orderBy("seq")
    assert [(r.city, r.value, r.max_value) for r in got.collect()] == [
        ("北京", 1, 1), ("上海", 2, 2), ("北京", 6, 6), ("上海", 8, 8), ("北京", 3, 6), ("上海", 4, 8)]
    best = max_row_by_key(df, "city", "value", "seq", df.columns)
    assert sorted((r.city, r.value) for r in best.collect()) == [("上海", 8), ("北京", 6)]


def test_broadcast_lookup_with_default(spark):
    students = inline_rows(spark, [(1, "张三"), (2, "李四"), (3, "王五")], "id int, name string")
    scores = inline_rows(spark, [(1, "语文", 50), (2, "数学", 70), (3, "英文", 86), (4, "体育", 99)],
                         "id int, subject string, score int")
    got = lookup_join(scores, dedupe_last(students, "id", "name"), "id", {"name": ""})
    assert sorted((r.name, r.subject, r.score) for r in got.collect()) == [
        ("", "体育", 99), ("张三", "语文", 50), ("李四", "数学", 70), ("王五", "英文", 86)]


def test_union_and_connect(spark):
    s1 = inline_rows(spark, [("alpha",), ("beta",), ("gamma",)], "v string")
    s2 = inline_rows(spark, [("alpha",), ("beta",), ("gamma",)], "v string")
    longs = inline_rows(spark, [(1,), (2,), (3,)], "v long")
    assert union_all(s1, s2).count() == 6
    out = connect_map(s1, lambda d: d.select(F.concat(F.lit("String -> String:"), "v").alias("value")),
                      longs, lambda d: d.select(F.concat(F.lit("Long -> String:"), F.col("v").cast("string")).alias("value")))
    vals = sorted(r.value for r in out.collect())
    assert vals == ["Long -> String:1", "Long -> String:2", "Long -> String:3",
                    "String -> String:alpha", "String -> String:beta", "String -> String:gamma"]


def test_side_outputs_even_odd(spark):
    df = inline_rows(spark, [(i,) for i in range(1, 11)], "value int")
    outs = split_by_tag(df, even_odd_tag("value"), ["even", "odd"])
    assert sorted(r.value for r in outs["even"].collect()) == [2, 4, 6, 8, 10]
    assert sorted(r.value for r in outs["odd"].collect()) == [1, 3, 5, 7, 9]


def test_rebalance_after_skewing_filter(spark):
    rows = inclusive_range(spark, 0, 100, num_partitions=4, name="value").where("value > 10")
    sizes = partition_sizes(rows.repartition(4)).collect()
    assert sum(r.rows for r in sizes) == 90
    assert max(r.rows for r in sizes) - min(r.rows for r in sizes) <= 4


def test_accumulator_counts_all_tasks(spark, tmp_path):
    df = inline_rows(spark, [("aaa",), ("bbb",), ("ccc",), ("ddd",)], "value string").repartition(2)
    counted, obs = observed_count(df)
    counted.write.mode("overwrite").text(str(tmp_path / "out"))
    assert obs.get["rows"] == 4


def test_sequences_include_both_ends(spark):
    assert inclusive_range(spark, 1, 10).count() == 10
    assert [r.id for r in inclusive_range(spark, 1, 10).orderBy("id").collect()] == list(range(1, 11))


CARS = ["9,3", "9,2", "9,7", "4,9", "2,6", "1,5", "2,3", "5,7", "5,4"]


def _cars(spark):
    lines = inline_rows(spark, [(i, l) for i, l in enumerate(CARS)], "seq long, value string")
    parts = F.split("value", ",")
    return lines.select("seq", parts[0].alias("id"), parts[1].cast("int").alias("count"),
                        F.lit("2024-01-01 00:00:01").cast("timestamp_ntz").alias("ts"))


def test_car_sample_one_time_window(spark):
    got = tumbling(_cars(spark), ["id"], "ts", "5 seconds", "count")
    assert sorted((r.id, int(r.sum_value)) for r in got.collect()) == [
        ("1", 5), ("2", 9), ("4", 9), ("5", 11), ("9", 12)]


def test_car_sample_count_windows(spark):
    cars = _cars(spark)
    assert count_windows(cars, ["id"], "seq", 5, 5, "count").count() == 0
    sliding = count_windows(cars, ["id"], "seq", 5, 3, "count").collect()
    assert [(r.id, int(r.sum_value)) for r in sliding] == [("9", 12)]
