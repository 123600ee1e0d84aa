"""Readers: parquet tables, text files (batch and stream), inline rows, ranges, JDBC, Kafka."""

from tidewater.sources.tables import TABLES, read_table
from tidewater.sources.text import read_text_lines, stream_text_lines
from tidewater.sources.inline import inline_rows, inclusive_range

__all__ = ["TABLES", "read_table", "read_text_lines", "stream_text_lines", "inline_rows", "inclusive_range"]
