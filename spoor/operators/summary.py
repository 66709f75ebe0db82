"""Reports over descriptors, curves and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.functions.numeric import int_div, named
from spoor.model import HEADER_COLS

# Fixed value: length in seconds of the slot that peaks are counted in.
PEAK_SECONDS = 300


def order_descriptors(headers: DataFrame, descending: bool = False) -> DataFrame:
    """Descriptors by served volume, name as tie-breaker."""
    volume = F.col("total_served_bytes")
    return headers.select(HEADER_COLS).orderBy(
        volume.desc() if descending else volume.asc(), "fd_id"
    )


def order_curves(curve: DataFrame, descending: bool = False) -> DataFrame:
    """Space curves by their largest size."""
    largest = curve.groupBy("fd_id").agg(F.max("mb").alias("max_mb"))
    size = F.col("max_mb")
    return largest.orderBy(size.desc() if descending else size.asc(), "fd_id")


def traffic_summary(headers: DataFrame) -> DataFrame:
    """Average and peak rates; averages are NULL for a duration of 0."""
    avg_bits = int_div("total_served_bytes * 8", "duration")
    peak_bits = int_div("peak_bytes_300s * 8", PEAK_SECONDS)
    return headers.selectExpr(
        "fd_id",
        *named({
            "avg_hits_per_s": int_div("total_requests", "duration"),
            "peak_hits_per_s": int_div("peak_requests_300s", PEAK_SECONDS),
            "avg_gbps": f"CAST({avg_bits} / 1e9D AS BIGINT)",
            "peak_gbps": f"{peak_bits} / 1e9D",
        }),
    )


def extents(rows: DataFrame) -> DataFrame:
    """Largest IAT, footprint and object count of each descriptor."""
    return rows.groupBy("fd_id").agg(
        F.max("delta_t").alias("max_delta_t"),
        F.max("mb").alias("max_mb"),
        F.max("objcount").alias("max_objcount"),
    )


def run_summary(done: DataFrame, rejected: DataFrame) -> DataFrame:
    """Number of results and of rejects; both need only a name column."""
    return (
        done.select(F.lit("ok").alias("status"))
        .unionByName(rejected.select(F.lit("failed").alias("status")))
        .groupBy("status")
        .agg(F.count("*").alias("n"))
    )


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)
