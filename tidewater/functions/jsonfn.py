"""JSON text <-> rows.

Writing: ``to_json(struct(...))`` with the fields in name order and nulls left
out, which is what the reference's JSON library prints for a bean.
Reading: message ids arrive as JSON *strings* under numeric columns; parse
with string fields, then cast, so ``"1"`` becomes ``1`` instead of null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_to_json(df: DataFrame, columns: list[str] | None = None, out: str = "value") -> DataFrame:
    cols = sorted(columns or df.columns)
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(out))


def parse_json_typed(col: Column | str, schema: T.StructType) -> Column:
    """Parse JSON text into ``schema``; every field is read as string first, then cast."""
    c = F.col(col) if isinstance(col, str) else col
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    parsed = F.from_json(c, as_text)
    return F.struct(*[parsed[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
