"""JDBC sinks.

Rows are inserted by the executors in batches (``batchsize``), one
connection per task; an auto-increment id column is left out so the database
assigns it. A stream writes each micro-batch the same way from
``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_jdbc(df: DataFrame, url: str, table: str, drop: tuple[str, ...] = ("id",), batch_size: int = 1000,
                properties: dict | None = None) -> None:
    out = df.drop(*[c for c in drop if c in df.columns])
    writer = (out.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
              .option("batchsize", batch_size))
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


def jdbc_batch_writer(url: str, table: str, **kwargs):
    """``foreachBatch`` function for a streaming JDBC sink."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        append_jdbc(batch, url, table, **kwargs)
    return write
