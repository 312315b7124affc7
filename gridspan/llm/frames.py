"""What the operators share: tables, the training split, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridspan.session import materialize, ship

#: Bytes of text that a task turns into numpy arrays at a time; a longer text is one slice.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a missing one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo `modulus`; NULL for a missing id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def held_out(modulus: int, rest: int) -> Column:
    """Whether a row's remainder is `rest`; a row without an id is not held out."""
    return F.coalesce(remainder(modulus) == rest, F.lit(False))


def row_key() -> Column:
    """What rows with the same id and text share, NULLs included."""
    return F.struct(F.col("doc_id"), F.xxhash64(F.col("text")).alias("h"))


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of a batch of about SLICE_BYTES of text, with the texts as UTF-8."""
    column = batch.column(batch.schema.get_field_index(text))
    if not len(column):
        return
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)))
    part = sizes // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        texts = column.slice(a, b - a).cast(pa.binary()).to_pylist()
        yield batch.slice(a, b - a), [x or b"" for x in texts]


def releasing(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """`run`, which gives what a task has freed back to the system when the task ends.

    A Python worker lives on and keeps freed memory, beside what later steps take in the JVM.
    """

    @wraps(run)
    def released(*args) -> Iterator:
        yield from run(*args)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU C library has it
        if trim:
            trim(0)

    return released


def lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """A list column out of all values and the length of each list."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def sized(df: DataFrame, most: int) -> DataFrame:
    """`df`, a stored table, marked for broadcast if it has at most `most` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """A stored copy of `leaves` with a position `pos` in their `group`, and its size `n`.

    Each row has a number first, which tells equal rows apart and makes ranges of equal size
    possible whatever ids repeat.
    """
    numbered = materialize(leaves.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    keys = ["group", *order, "_row"]
    ranged = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # An id's upper bits are its task's number, its lower ones count the rows in order.
    ranged = ranged.withColumn("_id", F.monotonically_increasing_id()).drop("_row")
    ranged = materialize(ranged, "ordered").withColumn("_task", F.shiftright("_id", 33))
    parts = ranged.groupBy("group", "_task").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    whole = Window.partitionBy("group")
    before = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "group", "_task",
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_size").over(whole).alias("n"),
    )
    rows = ranged.join(parts, ["group", "_task"])
    return rows.withColumn("pos", F.col("_id") + F.col("_shift")).drop("_task", "_id", "_shift")
