"""Kafka JSON sink: one JSON document per row, null key (the producer spreads
keyless records over partitions). Needs the Kafka connector on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewater.functions.jsonfn import rows_to_json


def to_kafka_records(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return rows_to_json(df, columns, out="value")


def write_kafka(df: DataFrame, servers: str, topic: str, columns: list[str] | None = None) -> None:
    (to_kafka_records(df, columns).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
