"""Ordered access without a single-task sort or window.

Rows are sorted across tasks by ranges of series, order and a number that tells equal keys
apart, so each task has its share of the rows whatever series or time holds most of them. A
row's position is its place in its range plus the rows of its series in earlier ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridspan.schemas import TRAIN_SHARE
from gridspan.session import materialize


def in_ranges(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A stored copy of `df`, sorted across tasks; `_id` ascends and its upper bits are the task."""
    keys = [*[F.col(b) for b in by], *[F.asc_nulls_last(c) for c in order], F.col("_tie")]
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    return materialize(rows.withColumn("_id", F.monotonically_increasing_id()), "ranges")


def with_position(df: DataFrame, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Adds `pos`, 1-based in `order` within `by`, and `n`, the series length.

    NULL times come last; rows with equal keys are in any order. The rows are written once,
    as their places in the ranges have to stay what they are.
    """
    # One struct key, because inside a struct NULLs are equal: no row is lost in the join.
    key = F.struct(*by, F.shiftright("_id", 33).alias("_task"))
    rows = in_ranges(df, order, by).withColumn("_key", key)

    parts = rows.groupBy("_key").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    series = Window.partitionBy(*[f"_key.{b}" for b in by])
    earlier = series.orderBy("_key._task").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    shifts = parts.select(
        "_key", (before - F.col("_first") + 1).alias("_shift"), F.sum("_size").over(series).alias("n")
    )
    return rows.join(shifts, "_key").select(
        *df.columns, (F.col("_id") + F.col("_shift")).alias("pos"), "n"
    )


def with_halo(
    df: DataFrame, depth: int, by: Sequence[str] = (), chunk: int = 4096
) -> DataFrame:
    """Cuts positioned series into chunks that each also see the `depth` rows before them.

    Adds `_chunk` and `_own`; a row is its own chunk's (`_own`) exactly once and is
    repeated as context for the chunks its successors fall in. Windows and grouped maps
    over (by, _chunk) are then bounded however long the series is.
    """
    first = F.floor((F.col("pos") - 1) / chunk)
    last = F.floor((F.col("pos") - 1 + depth) / chunk)
    own = df.withColumn("_home", first)
    return (
        own.withColumn("_chunk", F.explode(F.sequence(F.col("_home"), last)))
        .withColumn("_own", F.col("_chunk") == F.col("_home"))
        .drop("_home")
    )


def time_split(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = (),
    share: float = TRAIN_SHARE,
) -> DataFrame:
    """Marks the first int(n * share) rows of each series in time order as train."""
    positioned = with_position(df, order, by)
    cut = F.floor(F.col("n") * F.lit(share))
    return positioned.withColumn("train_size", cut).withColumn("is_train", F.col("pos") <= cut)


def lag_features(
    df: DataFrame,
    value: str,
    order: Sequence[str],
    lags: int,
    by: Sequence[str] = (),
    chunk: int = 4096,
) -> DataFrame:
    """Adds the first difference `diff` of `value` and its lags `lag_1`..`lag_<lags>`."""
    return positioned_lags(with_position(df, order, by), value, lags, by, chunk)


def positioned_lags(
    rows: DataFrame, value: str, lags: int, by: Sequence[str] = (), chunk: int = 4096
) -> DataFrame:
    """`lag_features` of rows that have their position already."""
    rows = with_halo(rows, lags + 1, by, chunk)
    past = Window.partitionBy(*by, "_chunk").orderBy("pos")
    rows = rows.withColumn("diff", F.col(value) - F.lag(value).over(past))
    rows = rows.select(
        "*", *[F.lag("diff", k).over(past).alias(f"lag_{k}") for k in range(1, lags + 1)]
    )
    return rows.filter("_own").drop("_own", "_chunk")


def head_tail(df: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The first and last `n` rows by unique `keys`, each a top-n without a full sort."""
    first = df.orderBy(*keys).limit(n).withColumn("part", F.lit("head"))
    last = df.orderBy(*[F.desc(k) for k in keys]).limit(n).withColumn("part", F.lit("tail"))
    return first.unionByName(last)
