"""Money arithmetic.

Sums of doubles depend on the order of addition, which a distributed
aggregate does not fix. Values are therefore summed as decimals with
``SCALE`` places (exact for values of that many places, order free) and turned
back into ``double`` at the end; nothing is rounded to cents before a sum. A value that
has no such decimal (not a number, infinite, 10^18 or more) counts as null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 9


def exact_money(col: Column | str, scale: int = SCALE) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(f"decimal({18 + scale},{scale})")


def round_half_up(col: Column | str, scale: int = 2) -> Column:
    """HALF_UP rounding on the decimal value (``round`` on decimals is HALF_UP)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("decimal(38,10)"), scale)
