"""Key-aligned measures and last-wins de-duplication, one shuffle each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.functions import value_or_zero


def _last(value: Column | str, order: Sequence[str], where: Column | None = None) -> Column:
    """The value of the last row by `order`; a NULL in the order comes before all else.

    A single order column keeps the aggregate of a fixed-width value hash-based; several
    compare as a struct. `max_by` passes over rows without an order, so where a group has
    no other rows its greatest value is taken.
    """
    if len(order) > 1:
        by = F.struct(*order)
        return F.max_by(value, by if where is None else F.when(where, by))
    value = F.col(value) if isinstance(value, str) else value
    by, any_value = F.col(order[0]), value
    if where is not None:
        by, any_value = F.when(where, by), F.when(where, value)
    return F.when(F.count(by) > 0, F.max_by(value, by)).otherwise(F.max(any_value))


def align_measures(
    df: DataFrame,
    keys: Sequence[str],
    tag: str,
    measures: Mapping[str, str],
    value: str,
    order: Sequence[str],
) -> DataFrame:
    """Full outer alignment of several tagged key/value lists, absent values being 0.

    `measures` maps an output column to its tag. Rows without a value are ignored, the
    last row by `order` wins. Conditional aggregates combine before the shuffle, so a
    hot key ships one row per task, and one shuffle does the work of the outer joins.
    """
    tagged = df.filter(F.col(value).isNotNull() & F.col(tag).isin(list(measures.values())))
    return tagged.groupBy(*keys).agg(
        *[
            value_or_zero(_last(value, order, F.col(tag) == m)).alias(name)
            for name, m in measures.items()
        ]
    )


def last_wins(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The last row per key by `order`, as an aggregate that combines before the shuffle."""
    kept = [*order, *[v for v in values if v not in order]]
    rows = df.groupBy(*keys).agg(_last(F.struct(*kept), order).alias("last"))
    return rows.select(*keys, *[F.col(f"last.{c}").alias(c) for c in kept])


def key_union(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct keys found in any of the frames.

    Lists that are parts of one frame take a single scan as `df.filter(tag.isin(...))` with
    that frame as the only one.
    """
    union = frames[0].select(*keys)
    for frame in frames[1:]:
        union = union.unionByName(frame.select(*keys))
    return union.distinct()
