"""Writers: text, JDBC, Kafka JSON and a keyed upsert table."""

from tidewater.sinks.text import write_text
from tidewater.sinks.upsert import UpsertLog

__all__ = ["write_text", "UpsertLog"]
