"""Total orders and top-k.

The reference sorts by a measure only; equal measures then come out in an
arbitrary order and a top-k cut is not reproducible. Every order here ends
in the key columns so results are a function of the data alone.
``orderBy(...).limit(k)`` plans ``TakeOrderedAndProject``: each task keeps
its own k best rows and only k x tasks rows reach the final merge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(spec) -> Column:
    if isinstance(spec, Column):
        return spec
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_last()
    return F.col(spec).asc_nulls_last()


def sort_total(df: DataFrame, *order) -> DataFrame:
    """Sort by ``order``; a leading ``-`` means descending (O1, O2)."""
    return df.orderBy(*[_order(o) for o in order])


def top_k(df: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows under a total ``order`` (O3)."""
    return sort_total(df, *order).limit(k)


def sort_small(df: DataFrame, *order) -> DataFrame:
    """Total order for a result whose size is bounded by its *domain*.

    For an aggregate over hours, vendors or boroughs (tens of rows whatever
    the data volume) a global sort's range partitioning costs a sampling job
    for nothing. Moving the finished rows to one partition and sorting there
    gives the same order. Only for such bounded results: the single partition
    receives every output row.
    """
    return df.repartition(1).sortWithinPartitions(*[_order(o) for o in order])
