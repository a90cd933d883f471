"""Exact, order-independent sums and means of doubles.

Double sums depend on the order rows meet in partial aggregates, so the same
query can print different last digits on different cluster layouts. Here a
value becomes an integer count of 10^-``decimals`` units, fine enough to hold
every decimal the data has (12 for degrees, 6 for money: nothing is rounded
to the precision of the report first), and the integers are summed as two LONG
limbs, which stays in generated code. Only the result is rounded. Limbs of 22
bits (24 for 12 decimals) cannot overflow below 2 * 10^12 (5 * 10^11) rows a
group; ANSI mode would raise, not wrap.

Values that are not finite, or too large for the limbs (beyond 1.7 * 10^7 of
money, 280 degrees), are summed as doubles beside the limbs and added at the
end, so NaN and infinities behave as in SQL ``sum`` and ``avg``.

Expressions are SQL text: eight sums need hundreds of nodes, and building each
by its own call took longer than the query at small sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_DECIMALS, DEGREE_DECIMALS = 6, 12


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _bits(decimals: int) -> int:
    return 24 if decimals > MONEY_DECIMALS else 22


def to_units(rows: DataFrame, keys: list[str], measures: dict[str, str], decimals: int) -> DataFrame:
    """``keys`` and, for each measure (output name -> column), its units and what has none.

    This projection below the aggregate converts each value once; the
    aggregate's buffers then read plain columns, and its generated code stays small.
    """
    limit, scale = 2.0 ** (2 * _bits(decimals)) / 10.0 ** decimals, 10.0 ** decimals
    out = []
    for name, x in measures.items():
        exact = f"abs(`{x}`) < {limit!r}D"  # false for NaN and infinities
        out += [f"CASE WHEN {exact} THEN CAST(rint(`{x}` * {scale!r}D) AS BIGINT) END AS `{name}_units`",
                f"CASE WHEN {exact} THEN NULL ELSE CAST(`{x}` AS DOUBLE) END AS `{name}_rest`"]
    return rows.selectExpr(*[f"`{k}`" for k in keys], *out)


def sum_parts(name: str, decimals: int, count: bool = False) -> dict[str, Column]:
    """Aggregates over the columns of :func:`to_units`; they hold a sum exactly and add up over groups.

    High and low limb, sum of all other values and, if asked for, the number of values.
    """
    bits = _bits(decimals)
    parts = {f"{name}_high": F.expr(f"sum(shiftright(`{name}_units`, {bits}))"),
             f"{name}_low": F.expr(f"sum(`{name}_units` & {(1 << bits) - 1}L)"),
             f"{name}_other": F.expr(f"sum(`{name}_rest`)")}
    n = {f"{name}_n": F.expr(f"count(coalesce(CAST(`{name}_units` AS DOUBLE), `{name}_rest`))")}
    return {**n, **parts} if count else parts


def part_names(name: str) -> list[str]:
    return [f"{name}_{p}" for p in ("high", "low", "other")]


def _units(name: str, decimals: int) -> str:
    """The summed units of finished parts as DECIMAL(38,0); 0 for no values."""
    high = f"CAST(coalesce(`{name}_high`, 0) AS DECIMAL(20,0)) * {1 << _bits(decimals)}"
    return f"CAST(CAST({high} AS DECIMAL(38,0)) + CAST(coalesce(`{name}_low`, 0) AS DECIMAL(38,0)) AS DECIMAL(38,0))"


def _as_double(units: str, decimals: int) -> str:
    """units / 10^decimals: the whole part and the fraction, each exact, added."""
    one = f"CAST({10 ** decimals} AS DECIMAL(38,0))"
    return (f"(CAST(({units} - {units} % {one}) / {one} AS DOUBLE)"
            f" + CAST({units} % {one} AS DOUBLE) / {10.0 ** decimals!r}D)")


def total_of(name: str, decimals: int = MONEY_DECIMALS) -> Column:
    """The sum that parts ``name`` hold, as a double; NULL for no values."""
    return F.expr(f"CASE WHEN `{name}_high` IS NOT NULL OR `{name}_other` IS NOT NULL THEN"
                  f" {_as_double(_units(name, decimals), decimals)} + coalesce(`{name}_other`, 0D) END")


def mean_of(name: str, decimals: int = DEGREE_DECIMALS, places: int = 6) -> Column:
    """The mean that parts ``name`` (with their number) hold, rounded to ``places`` exactly (ties to even).

    With values beside the limbs, the rounded double quotient.
    """
    units = _units(name, decimals)
    divisor = f"CAST(CAST(`{name}_n` AS DECIMAL(19,0)) * {10 ** (decimals - places)} AS DECIMAL(38,0))"
    rest = f"(abs({units}) % {divisor})"
    quotient = f"CAST((abs({units}) - {rest}) / {divisor} AS DECIMAL(38,0))"  # exact: divisible
    twice = f"CAST({rest} * 2 AS DECIMAL(38,0))"
    up = f"CASE WHEN {twice} > {divisor} OR ({twice} = {divisor} AND {quotient} % 2 = 1) THEN 1 ELSE 0 END"
    rounded = f"signum(CAST({units} AS DOUBLE)) * CAST({quotient} + {up} AS DOUBLE) / {10.0 ** places!r}D"
    plain = f"round(({_as_double(units, decimals)} + `{name}_other`) / `{name}_n`, {places})"
    return F.expr(f"CASE WHEN `{name}_n` > 0 THEN CASE WHEN `{name}_other` IS NULL THEN {rounded} ELSE {plain} END END")


def with_parts(rows: DataFrame, keys: list[str], measures: dict[str, str], decimals: int,
               count: bool = False) -> DataFrame:
    """The parts of several sums (output name -> column) per ``keys``, as one aggregate."""
    parts: dict[str, Column] = {}
    for name in measures:
        parts |= sum_parts(name, decimals, count)
    return (to_units(rows, keys, measures, decimals).groupBy(*keys)
            .agg(*[column.alias(name) for name, column in parts.items()]))


def round_to(x, decimals: int) -> Column:
    """Fixed-precision result formatting that keeps the numeric type (X12)."""
    return F.round(_c(x), decimals)
