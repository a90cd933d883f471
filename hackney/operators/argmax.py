"""Per-key arg-max and ordered first, as single-pass aggregates.

``max(struct(v, tie...))`` picks the whole winning row in one aggregation
with partial (map-side) combine, so a hot key never gathers its rows in one
task; struct ordering is lexicographic, which gives an explicit tie rule. It
takes any types, and plans a sort aggregate. Where the tie-breaker is a whole
number, :func:`arg_max_packed` and :func:`first_packed` hold value and
tie-breaker in one DECIMAL, which a hash aggregate updates in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.functions.ordering import pack, unpack_low, with_order_key


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def arg_max(df: DataFrame, keys: list[str], order: list,
            payload: dict[str, Column | str]) -> DataFrame:
    """One row per key: ``payload`` taken from the row with the largest ``order``.

    ``order`` columns compare lexicographically (later ones break ties of
    earlier ones); a NULL order sorts below every value.
    """
    # A payload that is itself an order column is read back from the order
    # field, keeping the struct (and the sort buffer) narrow.
    slots = {o: f"_o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    extra = {name: v for name, v in payload.items() if not (isinstance(v, str) and v in slots)}
    best = F.struct(*[_c(o).alias(f"_o{i}") for i, o in enumerate(order)],
                    *[_c(v).alias(f"_p_{name}") for name, v in extra.items()])
    agg = df.groupBy(*keys).agg(F.max(best).alias("_best"))
    field = {name: slots[v] if name not in extra else f"_p_{name}" for name, v in payload.items()}
    return agg.select(*keys, *[F.col(f"_best.{field[name]}").alias(name) for name in payload])


def ordered_first(value, order: list) -> Column:
    """``first(value)`` made deterministic: ``value`` of the row with the smallest
    ``order`` (lexicographic; rows whose first order column is NULL are skipped)."""
    first = _c(order[0])
    row = F.struct(*[_c(o).alias(f"_o{i}") for i, o in enumerate(order)],
                   _c(value).alias("_v"))
    return F.min(F.when(first.isNotNull(), row))["_v"]


def arg_max_packed(df: DataFrame, keys: list[str], value: str, tie: str, extra: list[Column] = ()) -> DataFrame:
    """One row per key: the largest double ``value`` and, of its rows, the largest whole number ``tie``.

    NULL sorts below every value and NaN above, as in :func:`arg_max`. ``extra``
    are further aggregates (over ``df``'s columns) of the same pass.
    """
    keyed = with_order_key(df, value, "__key")
    agg = keyed.groupBy(*keys).agg(F.max(pack("__key", f"`{tie}`")).alias("__best"), F.max(value).alias(value), *extra)
    return agg.withColumn(tie, unpack_low(F.col("__best"))).drop("__best")


def first_packed(value: str, time: str) -> Column:
    """The whole number ``value`` of the row with the earliest ``time``; the least of several, NULL first.

    As :func:`ordered_first` by time and value; rows without a time are skipped.
    """
    micros = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{time}`)"
    return unpack_low(F.min(F.when(F.col(time).isNotNull(), pack(micros, f"`{value}`"))))
