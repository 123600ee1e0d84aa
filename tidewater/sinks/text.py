"""Text sink: one line per row, overwrite.

Each task writes its own file (a folder of part files). ``single_file``
gathers the rows in one task and is only for results known to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_text(df: DataFrame, path: str, column: str = "value", single_file: bool = False,
               compression: str | None = None) -> None:
    out = df.select(df[column].cast("string").alias("value")).where("value is not null")     # a null is no line, not an empty one
    if single_file:
        out = out.repartition(1)      # one writer; the work above keeps its tasks
    writer = out.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
