"""Parity of the JVM ``String.hashCode`` without a UDF.

``hashCode = sum(c_i * 31^(n-1-i)) mod 2^32``; 31 is odd, so the parity of the
hash equals the parity of the sum of the character codes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def char_code_parity(col: Column | str, integral: bool = False) -> Column:
    """0 when the JVM string hash of the value is even, 1 when odd.

    ``integral=True`` for the decimal text of integer ids: the only characters
    with odd codes are the digits 1 3 5 7 9 and '-', so the parity is the
    parity of their count (a code-generated regex instead of a per-character
    lambda).
    """
    c = F.col(col) if isinstance(col, str) else col
    if integral:
        odd = F.length(F.regexp_replace(c.cast("string"), "[^13579-]", ""))
        return F.pmod(odd, F.lit(2)).cast("int")
    codes = F.transform(F.split(c.cast("string"), ""), lambda ch: F.ascii(ch).cast("long"))
    return F.pmod(F.aggregate(codes, F.lit(0).cast("long"), lambda acc, x: acc + x), F.lit(2)).cast("int")
