"""Text splitting with the exact semantics of Java's ``String.split(" ")``.

Java drops trailing empty strings, keeps leading and inner ones, returns
``[""]`` for the empty string and ``[]`` for a string of only separators.
Spark's ``split`` keeps trailing empties, so trailing separators are trimmed
first. Everything stays a JVM expression (no Python per row).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_split(col: Column | str, sep: str = " ") -> Column:
    """``array<string>`` equal to Java ``s.split(sep)`` for a one-character ``sep``."""
    c = F.col(col) if isinstance(col, str) else col
    pat = re.escape(sep)
    # rtrim() removes ASCII spaces only, exactly the trailing separators for " "
    stripped = F.rtrim(c) if sep == " " else F.regexp_replace(c, f"(?:{pat})+$", "")
    return (
        F.when(c == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, pat))
    )


def without_cr(c: Column) -> Column:
    """The text without one final carriage return."""
    return F.when(c.endswith("\r"), F.left(c, F.char_length(c) - 1)).otherwise(c)


def text_lines_of(col: Column | str) -> Column:
    """Lines of a text value, as a line reader would return them (``\\n`` or ``\\r\\n`` ends a line)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.split(without_cr(F.replace(c, F.lit("\r\n"), F.lit("\n"))), "\n")


def tokens_of(col: Column | str, sep: str = " ") -> Column:
    """Tokens of a text value: lines first, then Java split of each line."""
    return F.flatten(F.transform(text_lines_of(col), lambda line: java_split(line, sep)))
