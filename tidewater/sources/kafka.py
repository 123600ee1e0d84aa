"""Kafka sources as thin readers over tested value transforms.

The Kafka connector package is not part of this environment; the readers
below need it on the classpath (``spark.jars.packages``). Everything after
the read (cast of ``value`` to text, JSON decoding) is a plain column
transform tested on JSON text files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.jsonfn import parse_json_typed


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest") -> DataFrame:
    """Values as text. Progress lives in the query checkpoint, not in a consumer group."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .select(F.col("value").cast("string").alias("value")))


def decode_json_values(values: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text -> typed columns (ids sent as JSON strings are cast, not nulled)."""
    return values.select(parse_json_typed(column, schema).alias("_tw_r")).select("_tw_r.*")
