"""Text line sources.

``spark.read.text`` reads a file, a folder or a glob, and decompresses by file
suffix (``.gz``, ``.bz2``, ...). Folders are not read recursively unless asked.
Lines end with ``\\n``; one ``\\r`` before it belongs to the line end (a lone ``\\r`` does
not end a line), as :func:`tidewater.functions.text.text_lines_of` has it.
A live line source (a socket in a demo) is a folder stream here: new files are
new lines, and the stream's checkpoint remembers which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import without_cr


def _without_cr(lines: DataFrame) -> DataFrame:
    return lines.withColumn("value", without_cr(F.col("value")))


def read_text_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """One row per line, column ``value``."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("lineSep", "\n")
    return _without_cr(reader.text(path))


def stream_text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _without_cr(reader.load(path))
