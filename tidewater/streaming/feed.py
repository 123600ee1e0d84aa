"""Feed a table into a file stream in arrival order.

A live source delivers rows in order. Here the table is cut into ``pieces`` consecutive ranges of an order column; rows
without an order come first. One query stays alive: a slice is written aside (as many files as its writers make), its folder is moved
into the source folder in one step, and the query works it off before the next one lands. So one slice is one micro-batch, whatever the
number of files, and there is one start of the query, not one per slice. Where moving a folder is not one step (object stores), or to
restart the query at every slice, use :func:`run_available_now` after each :meth:`SliceFeed.land`.

``closing`` ends a bounded run: one more row, later than all others by that
interval and null but for the order and the event time, moves the watermark
past every open window and timer, as a live source that goes on would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import move_folder


class SliceFeed:
    """The source folder of a stream and the slices that are still to land."""

    def __init__(self, df: DataFrame, order: str, pieces: int, path: str,
                 closing: tuple[str, str] | None = None):
        self.df, self.order, self.path, self.closing = df, order, path, closing
        bounds = df.agg(F.min(order).alias("lo"), F.max(order).alias("hi"), F.count(F.lit(1)).alias("n")).first()
        self.todo, self.landed, self.rows = [], 0, bounds["n"]
        self.closing_order = (bounds["hi"] or 0) + 1     # of the closing row: later than all others
        if bounds["n"]:
            lo, hi = bounds["lo"] or 0, bounds["hi"] or 0
            width = (hi - lo) // pieces + 1
            self.todo = [(lo + i * width, lo + (i + 1) * width) for i in range(pieces)]
        self._write(df.limit(0))                         # the folder exists before the stream starts
        self.stream = df.sparkSession.readStream.schema(df.schema).parquet(f"{path}/in/*")

    def _write(self, rows: DataFrame) -> None:
        name = f"slice-{self.landed:06d}"
        rows.write.mode("overwrite").parquet(f"{self.path}/aside/{name}")
        move_folder(rows.sparkSession, f"{self.path}/aside/{name}", f"{self.path}/in/{name}")
        self.landed += 1

    def land(self) -> bool:
        """Land the next slice; False when nothing is left. After the last slice comes the closing row."""
        if self.todo:
            (lo, hi), first = self.todo.pop(0), self.landed == 1
            mine = (F.col(self.order) >= lo) & (F.col(self.order) < hi)
            self._write(self.df.where(mine | F.col(self.order).isNull() if first else mine))
            return True
        if self.closing and self.landed > 1:
            ts, later = self.closing
            self.closing = None
            last = self.df.agg(F.max(ts).alias("t"))
            row = [(F.lit(self.closing_order) if f.name == self.order else F.col("t") + F.expr(f"INTERVAL {later}") if f.name == ts
                    else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.df.schema.fields]
            self._write(last.select(*row))
            return True
        return False

    def drain(self, query_builder, checkpoint: str) -> None:
        """Land every slice in turn and let one query work it off."""
        drain_together([self], query_builder, checkpoint)


def drain_together(feeds: list[SliceFeed], query_builder, checkpoint: str, behind: int = 0) -> None:
    """Run one query over all feeds. In every turn each feed lands a slice, those after the first ``behind`` turns later
    (slower sources); then the query works off what is there."""
    builder, query, turn, open_ = query_builder.option("checkpointLocation", checkpoint), None, 0, list(feeds)
    try:
        while open_ or query is None:
            open_ = [f for f in open_ if (f is not feeds[0] and turn < behind) or f.land()]
            if open_ or query is None:
                query = query or builder.start()         # the first slice is there, so it is the first micro-batch
                query.processAllAvailable()
            turn += 1
    finally:
        if query is not None:
            query.stop()


def run_available_now(query_builder, checkpoint: str):
    """Start a ``DataStreamWriter`` with ``availableNow``, wait for it to drain."""
    q = query_builder.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def stream_folder(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
