"""Polling source with a saved position (Spark's Python data source API).

A poll reads a whole table again and tags its rows with the poll's number. The stream's offset is the number of polls that are due; it
is kept in the query's checkpoint, so a query that is stopped in the middle goes on with the poll it had not finished, and never
repeats one that it had. The source itself gives the work list, one row per poll and key range, cut into one input
partition per range; the ranges meet the rows of the table in a join, so the table is read by Spark's own
readers (any format, any store, pruned columns) and its current state is read at every poll.
"""

from __future__ import annotations

import sys
import time

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # readers run in Python workers without this package


class PollRange(InputPartition):
    def __init__(self, poll: int, piece: int):
        self.poll, self.piece = poll, piece


class PollReader(DataSourceStreamReader):
    """Options: ``pieces`` (key ranges), and either ``due`` (number of polls that are due) or ``start`` and ``every`` (seconds)."""

    def __init__(self, options: dict):
        self.pieces = int(options["pieces"])
        self.due = int(options["due"]) if "due" in options else None
        self.start, self.every = float(options.get("start", 0)), float(options.get("every", 5))

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def latestOffset(self) -> dict:
        """Made from the options and the clock alone, so a restarted source agrees with its checkpoint."""
        return {"poll": self.due if self.due is not None else max(0, int((time.time() - self.start) // self.every))}

    def partitions(self, start: dict, end: dict) -> list[PollRange]:
        return [PollRange(p, r) for p in range(start["poll"], end["poll"]) for r in range(self.pieces)]

    def read(self, partition: PollRange):
        yield (partition.poll, partition.piece)

    def commit(self, end: dict) -> None:
        """Nothing to do: the position is in the checkpoint."""


class TablePolls(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidewater_polls"

    def schema(self) -> str:
        return "poll_id long, piece long"

    def streamReader(self, schema) -> PollReader:
        return PollReader(self.options)


def poll_stream(spark: SparkSession, table: DataFrame, key: str, pieces: int, **options) -> DataFrame:
    """A stream of (poll_id, the table's columns): every poll has all rows of the table. Key ranges are cut by a hash
    of the key, so they are even for any key, and rows without a key are in one of them."""
    spark.dataSource.register(TablePolls)
    reader = spark.readStream.format("tidewater_polls").option("pieces", pieces)
    for name, value in options.items():
        reader = reader.option(name, value)
    dealt = table.withColumn("piece", F.pmod(F.xxhash64(key), F.lit(pieces)))
    return reader.load().join(dealt, "piece").select("poll_id", *table.columns)
