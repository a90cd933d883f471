"""Result presentation: fixed precision and short labels (X12, X13, S11).

Queries return full-precision DataFrames; these helpers shape a *finished*
result for printing, still as DataFrames (the caller decides to ``show``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hackney.operators.topk import top_k


def report(df: DataFrame, decimals: int = 2, label_width: int | None = None) -> DataFrame:
    """Round every floating column to ``decimals`` places (numeric type kept)
    and cut string columns to ``label_width`` characters."""
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c, decimals)
        elif label_width is not None and isinstance(field.dataType, T.StringType):
            c = F.substring(c, 1, label_width)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def preview(df: DataFrame, n: int = 20, *order) -> DataFrame:
    """The first ``n`` rows: of ``df`` as it is ordered (what ``show(n)`` prints), or
    under ``order`` (as ``operators.top_k``; end it with key columns for a result
    that depends on the data alone)."""
    return top_k(df, n, *order) if order else df.limit(n)
