"""Column-level helpers: every function returns a Spark ``Column`` (JVM side)."""

from tidewater.functions.text import java_split, text_lines_of, tokens_of
from tidewater.functions.timefn import epoch_micros, epoch_millis, from_epoch_micros, to_event_time
from tidewater.functions.money import exact_money, round_half_up
from tidewater.functions.hashing import char_code_parity
from tidewater.functions.jsonfn import rows_to_json, parse_json_typed

__all__ = [
    "java_split", "text_lines_of", "tokens_of",
    "epoch_micros", "epoch_millis", "from_epoch_micros", "to_event_time",
    "round_half_up", "exact_money",
    "char_code_parity", "rows_to_json", "parse_json_typed",
]
