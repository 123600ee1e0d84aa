"""Column helpers: Java split, JSON typing, hash parity, time conversions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import char_code_parity, epoch_micros, from_epoch_micros, java_split, parse_json_typed
from tidewater.functions.jsonfn import rows_to_json
from tidewater.functions.text import tokens_of


def test_java_split_semantics(spark):
    df = spark.createDataFrame([("a b ",), ("",), ("  ",), (" a  b",), ("x",)], "s string")
    got = [r[0] for r in df.select(java_split("s")).collect()]
    assert got == [["a", "b"], [""], [], ["", "a", "", "b"], ["x"]]


def test_tokens_split_lines_first(spark):
    df = spark.createDataFrame([("Hello World\nhaha  x",)], "t string")
    assert df.select(tokens_of("t")).first()[0] == ["Hello", "World", "haha", "", "x"]


def test_json_ids_sent_as_strings_are_cast(spark):
    msgs = ['{"user_id": "1", "page_id":"1", "status": "success"}'] * 4 + \
           ['{"user_id": "1", "page_id":"1", "status": "fail"}']
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("page_id", T.LongType()),
                           T.StructField("status", T.StringType())])
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    rows = df.select(parse_json_typed("value", schema).alias("r")).select("r.*")
    ok = rows.where("status = 'success'").collect()
    assert len(ok) == 4 and all(r.user_id == 1 and r.page_id == 1 for r in ok)


def test_to_json_orders_fields_and_drops_nulls(spark):
    df = spark.createDataFrame([(None, "toney", 19)], "id int, name string, age int")
    assert rows_to_json(df).first()[0] == '{"age":19,"name":"toney"}'


def test_string_hash_parity_matches_jvm(spark):
    words = ["0", "1", "17", "abc", "order-42", "99999"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(char_code_parity("w")).collect()]

    def jvm_hash(s):
        h = 0
        for ch in s:
            h = (31 * h + ord(ch)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= (1 << 31) else h

    assert got == [0 if jvm_hash(w) % 2 == 0 else 1 for w in words]


def test_epoch_roundtrip_is_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:00:07.5' AS ts")
        r = df.select(epoch_micros("ts").alias("us"), from_epoch_micros(epoch_micros("ts")).alias("back")).first()
        assert r.us == 1704067207500000
        assert str(r.back) == "2024-01-01 00:00:07.500000"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_integral_parity_fast_path_equals_general(spark):
    ids = [0, 1, 7, 10, 99, 12345, -3, -40, 9876543210, -9223372036854775808]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    fast = [r[0] for r in df.select(char_code_parity("id", integral=True)).collect()]
    slow = [r[0] for r in df.select(char_code_parity(F.col("id").cast("string"))).collect()]
    assert fast == slow
