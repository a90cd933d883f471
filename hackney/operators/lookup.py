"""Dimension lookups (id -> attributes) joined onto fact tables.

A lookup key must be unique: a duplicated id would silently multiply facts.
``lookup_join`` therefore joins the dimension grouped by its key, and a key
that occurs twice fails the job with the same error whatever the dimension's
size. The check is part of the plan (a partial and a final aggregate of the
dimension), so building a query runs nothing.

How the join runs is left to the optimiser, which knows both sides' bytes: a
small dimension is broadcast (``spark.sql.autoBroadcastJoinThreshold``, or at run
time by adaptive execution), a large one is joined by shuffle. That choice
never changes a result. Callers aggregate facts on the ids first
(``hackney.plans.queries``), so even the shuffle join meets one row per id and
task instead of raw facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_side(dim: DataFrame, key: str, columns: dict[str, str], key_alias: str) -> DataFrame:
    """``dim`` with one row per non-NULL key: the key and ``columns`` renamed.

    A key that occurs more than once raises an error when the rows are used.
    """
    twice = F.raise_error(F.concat(F.lit(f"lookup key {key!r} is not unique: "), F.col(key_alias).cast("string")))
    grouped = (dim.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(key_alias))
               .agg(F.count(F.lit(1)).alias("__n"), *[F.first(src).alias(dst) for src, dst in columns.items()]))
    return grouped.select(F.when(F.col("__n") == 1, F.col(key_alias)).otherwise(twice).alias(key_alias),
                          *columns.values())


def lookup_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                columns: dict[str, str], how: str = "left", default: str | None = None) -> DataFrame:
    """Attach dimension attributes to ``facts`` by ``fact_key == dim_key``.

    ``columns`` maps dimension column -> output name, so the same dimension
    can be joined twice in different roles (pick-up and drop-off) without
    ambiguous references. ``how`` is ``left`` (keep unmatched facts, J2),
    ``inner`` (drop them, J3) or ``left`` with ``default`` (label them, J4).
    """
    key_alias = f"__lookup_{fact_key}"
    side = unique_side(dim, dim_key, columns, key_alias)
    joined = facts.join(side, facts[fact_key] == side[key_alias], how).drop(key_alias)
    if default is not None:
        for dst in columns.values():
            joined = joined.withColumn(dst, F.coalesce(F.col(dst), F.lit(default)))
    return joined


def count_per(facts: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Fact rows counted per ``keys`` (the eager aggregate before a lookup)."""
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_again(df: DataFrame, keys: list[str | Column], measures: list[str]) -> DataFrame:
    """Additive ``measures`` summed over ``keys`` once more, after a lookup."""
    return df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
