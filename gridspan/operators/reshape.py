"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gridspan import schemas


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str] = tuple(schemas.ZONAL_IDS),
    values: Sequence[str] | None = tuple(schemas.ZONES),
    name: str = "Zone",
    value: str = "Value",
) -> DataFrame:
    """One row per id row and value column, empty cells included; no shuffle.

    `values=None` unpivots every column that is not an id.
    """
    missing = missing_columns(df, [*ids, *(values or [])])
    if missing:
        raise KeyError(f"the wide table lacks {missing}")
    return df.unpivot(list(ids), list(values) if values is not None else None, name, value)
