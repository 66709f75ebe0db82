"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoor.session import materialize

Batches = Iterator[pa.RecordBatch]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that further columns
    of the input can't clash with them: ``pick(df, id="doc_id", text="body")``."""
    return df.select(*[F.col(f"`{c}`").alias(own) for own, c in columns.items()])


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, to be carried beside an operator's own columns."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a text column, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def sliced(batches: Batches, rows: int = 500) -> Batches:
    """The same rows in smaller batches: what is made of a batch as a whole stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def window_codes(ids: np.ndarray, k: int) -> np.ndarray:
    """One number per window of k consecutive ids; equal numbers mean equal windows."""
    if len(ids) < k:
        return np.empty(0, np.int64)
    code, base = ids.astype(np.int64), int(ids.max()) + 1
    most = base - 1
    for i in range(1, k):
        if (most + 1) * base >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            most = int(code.max())
        code = code[:-1] * base + ids[i : len(ids)]
        most = most * base + base - 1
    return code


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n positions lie in one of the ranges."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:n]) > 0


def gathered(offsets: np.ndarray, flat: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """flat[offsets[i]:offsets[i + 1]] for every i of ``wanted``, in a row."""
    n = offsets[wanted + 1] - offsets[wanted]
    first = np.cumsum(n) - n
    return flat[np.repeat(offsets[wanted] - first, n) + np.arange(int(n.sum()))]


def in_arrow(df: DataFrame, make: Callable[[], Callable[[Batches], Batches]], schema: str):
    """mapInArrow with state that each task builds for itself."""

    def run(batches: Batches) -> Batches:
        yield from make()(batches)
        tidied()

    return df.mapInArrow(run, schema)


def tidied() -> None:
    """Give memory that a task has freed back to the system: the worker lives on and works
    for other tasks, beside an executor that has a budget of its own."""
    pa.default_memory_pool().release_unused()
    trim = _trim()
    if trim is not None:
        trim(0)


@lru_cache(maxsize=1)
def _trim():
    """glibc's malloc_trim, None where there is no such function."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


def inside(batch: pa.RecordBatch, row: str, column: str) -> list[bytes]:
    """``texts`` of a field of a struct column."""
    return [x or b"" for x in batch.column(row).field(column).cast(pa.binary()).to_pylist()]


def numbered(df: DataFrame, by: list[str | Column], group: tuple[str, ...] = (),
             name: str = "at") -> DataFrame:
    """``df`` with the place (long, from 0) of each row in its group, by the order of ``by``.

    Rows are dealt by ranges of the whole order, so a large group lies in many tasks; the
    places follow from the number of rows per group and range, which is a small table.
    Rows equal in ``by`` get places in no particular order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*group, *by]
    stored = materialize(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()), "ordered")
    stored = stored.withColumn("_range", F.shiftright("_row", 33))
    keys = [F.col(g).alias(f"_of_{g}") for g in group]
    runs = stored.groupBy(*keys, F.col("_range").alias("_of_range")).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*[f"_of_{g}" for g in group]).orderBy("_of_range").rowsBetween(
        Window.unboundedPreceding, -1)
    runs = materialize(runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))),
                       "ranges")
    same = F.col("_range") == F.col("_of_range")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return stored.join(runs, same).select(
        *df.columns, (F.col("_row") - F.col("_first") + F.col("_before")).alias(name))
