"""One key holding a third of all rows: it is split into bounded chunks and
the results equal the plain (unsplit) computation."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.running import CHUNK_COLUMN, RunningSpec, row_chunk, running_aggregate, with_chunks
from tidewater.operators.windows import count_windows

N = 3000
WIDTH = 64
THRESHOLD = 200


def _skewed(spark):
    # key 0 gets every third row; the rest spread over 400 keys
    return spark.range(N).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 400 + 1).alias("k"),
        ((F.col("id") * 7919) % 1000 / 10).alias("v"))


def test_hot_key_is_split_and_cold_keys_stay_whole(spark):
    df = _skewed(spark)
    chunks, split = with_chunks(df, ["k"], row_chunk("seq", WIDTH), THRESHOLD)
    assert split
    per = chunks.groupBy("k", CHUNK_COLUMN).count()
    hot = per.where("k = 0").collect()
    assert len(hot) >= N // 3 // WIDTH               # the hot key is cut into many chunks
    assert max(r["count"] for r in hot) <= WIDTH      # each chunk is bounded
    cold = per.where("k != 0").groupBy("k").count().where("count > 1").count()
    assert cold == 0                                  # cold keys stay one chunk


def test_running_sum_on_skewed_data_equals_plain_window(spark):
    df = _skewed(spark)
    got = running_aggregate(df, keys=["k"], order=["seq"], chunk=row_chunk("seq", WIDTH),
                            specs=[RunningSpec("s", "sum", F.col("v").cast("decimal(18,2)")),
                                   RunningSpec("n", "count")], hot_threshold=THRESHOLD)
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("seq", F.sum(F.col("v").cast("decimal(18,2)")).over(w).alias("s"),
                    F.row_number().over(w).alias("n"))
    bad = got.join(ref.withColumnRenamed("s", "s2").withColumnRenamed("n", "n2"), "seq") \
        .where("s != s2 or n != n2").count()
    assert bad == 0 and got.count() == N


def test_count_windows_on_skewed_data(spark):
    df = _skewed(spark)
    got = count_windows(df, ["k"], "seq", 5, 3, "v", chunk_width=WIDTH, hot_threshold=THRESHOLD)
    w = Window.partitionBy("k").orderBy("seq")
    r = df.withColumn("rn", F.row_number().over(w)).withColumn(
        "s", F.sum(F.col("v").cast("decimal(18,2)")).over(w.rowsBetween(-4, 0)))
    exp = r.where("rn % 3 = 0").select("k", (F.col("rn") / 3).cast("long").alias("window_index"),
                                        F.col("s").cast("double").alias("sum_value"))
    a = sorted((x.k, x.window_index, round(x.sum_value, 2)) for x in got.collect())
    b = sorted((x.k, x.window_index, round(x.sum_value, 2)) for x in exp.collect())
    assert a == b
