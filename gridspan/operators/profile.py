"""Table profiles: shape, types, missing values and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspan.functions import is_missing

# Bytes of one value, by type; other types are measured on their text.
FIXED_WIDTH = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
    "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def _bytes(column: str, data_type: str) -> Column:
    width = FIXED_WIDTH.get(data_type)
    if width is not None:
        return F.count(column) * width
    text = column if data_type in ("string", "binary") else F.to_json(F.struct(column))
    return F.coalesce(F.sum(F.octet_length(text)), F.lit(0))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows, missing values and bytes of data.

    All columns are measured in one pass; NaN counts as missing.
    """
    measures = []
    for i, (column, data_type) in enumerate(df.dtypes):
        measures.append(F.count_if(is_missing(column, data_type)).alias(f"missing_{i}"))
        measures.append(_bytes(column, data_type).alias(f"bytes_{i}"))
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *measures)
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(column).alias("column_name"),
            F.lit(data_type).alias("data_type"),
            F.col("row_count"),
            F.lit(len(df.columns)).alias("column_count"),
            F.col(f"missing_{i}").cast("bigint").alias("null_count"),
            F.col(f"bytes_{i}").cast("bigint").alias("data_bytes"),
        )
        for i, (column, data_type) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def distinct_counts(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), approximate: bool = False
) -> DataFrame:
    """Distinct non-NULL values per column, exact by default."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.groupBy(*by).agg(*[count(F.col(c)).alias(f"distinct_{c}") for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, NULL included, with their row counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
