"""Order-preserving integers, so that a hash aggregate can hold an arg-max.

``max(struct(...))`` needs a buffer that a hash aggregate cannot update in
place and so sorts each task's rows. Numbers it can: a double becomes the
LONG that orders as the double does, and two orders become one DECIMAL whose
high digits are the first and whose low digits the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The low half of a packed key holds whole numbers of less than this size, and NULL.
LOW = 2 ** 41


def with_order_key(df: DataFrame, x: str, key: str) -> DataFrame:
    """``df`` and a LONG ``key`` that orders as the double ``x`` does; no two different doubles share one.

    NULL comes first, then -Infinity ... -0.0 = 0.0 ... Infinity, then NaN.
    The key of a positive number is its binary64 bit pattern: with e the
    exponent, ``|x| / 2^e`` lies in [1, 2). ``log2`` may miss e by one at a
    power of two, which that range shows. All steps but ``log2`` are exact.
    Each step is a projection of its own, so nothing is computed twice.
    """
    def bits(exponent: str, ratio: str) -> str:
        return f"({exponent} + 1023L) * {2 ** 52}L + CAST(({ratio} - 1D) * {2.0 ** 52!r}D AS BIGINT)"

    stepped = (df.selectExpr("*", f"CAST(floor(log2(abs(`{x}`))) AS BIGINT) AS __exp")
               .selectExpr("*", f"abs(`{x}`) * pow(2D, -CAST(__exp AS DOUBLE)) AS __ratio"))
    return stepped.selectExpr(*[f"`{c}`" for c in df.columns], f"""
        CASE WHEN `{x}` IS NULL THEN -{2 ** 63 - 1}L WHEN isnan(`{x}`) THEN {2 ** 63 - 1}L ELSE
            (CASE WHEN `{x}` < 0D THEN -1L ELSE 1L END)
            * (CASE WHEN abs(`{x}`) < {2.0 ** -1022!r}D
                    THEN CAST(abs(`{x}`) * {2.0 ** 537!r}D * {2.0 ** 537!r}D AS BIGINT)
                    WHEN abs(`{x}`) = double('Infinity') THEN {2047 * 2 ** 52}L
                    WHEN __ratio >= 2D THEN {bits("__exp + 1", "__ratio / 2D")}
                    WHEN __ratio < 1D THEN {bits("__exp - 1", "__ratio * 2D")}
                    ELSE {bits("__exp", "__ratio")} END)
        END AS `{key}`""")


def pack(high: str, low: str) -> Column:
    """One DECIMAL that orders by the LONG ``high``, then by the whole number ``low`` (NULL first).

    ``low`` must be of less than LOW in size (seconds of 69,000 years); a
    greater one is an error, not a wrong order.
    """
    digit = (f"CASE WHEN {low} IS NULL THEN 0L WHEN abs({low}) < {LOW}L THEN {low} + {LOW}L"
             " ELSE CAST(raise_error('value too large for a packed order') AS BIGINT) END")
    return F.expr(f"CAST(CAST({high} AS DECIMAL(19,0)) * CAST({2 * LOW}L AS DECIMAL(13,0))"
                  f" + CAST({digit} AS DECIMAL(13,0)) AS DECIMAL(38,0))")


def unpack_low(packed: Column) -> Column:
    """The ``low`` of a packed key."""
    digit = F.pmod(packed, F.lit(2 * LOW).cast("decimal(38,0)")).cast("long")
    return F.when(digit > 0, digit - F.lit(LOW))
