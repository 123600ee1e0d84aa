import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from (doc_id, text[, lang, source]) rows, with extra columns whose names clash with results."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(full, SCHEMA)
        return df.withColumn("score", F.lit("x")).withColumn("size", F.lit(-1)).withColumn("kept", F.lit("?")).withColumn("class", F.lit(0))

    return make


@pytest.fixture()
def tables(tmp_path):
    """Write frames as <name>.parquet below a folder and give the folder."""
    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "a"), (5, "a"), (5, "a"), (None, "a"), (6, "one two three four five six"),
    (7, "one two three four five six"), (8, "x" * 30000), (9, ("long line of words " * 4000).strip()), (10, "é\u00a0\u2028 \U0001f642 ok"),
    (11, "null source", "en", None), (12, "other", None, "t"),
]
