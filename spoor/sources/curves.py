"""Text form of space and count curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.sources.descriptors import write_lines
from spoor.sources.lines import (
    COUNT_PREFIX,
    SPACE_PREFIX,
    base_name,
    folder_value,
    integer,
    read_lines,
    strip_key,
    tokens,
)

# Order of the numbers in a curve's header line.
CURVE_HEADER_FIELDS = [
    "total_requests",
    "total_served_bytes",
    "duration",
    "unique_objects",
    "unique_bytes",
    "peak_requests_300s",
    "peak_bytes_300s",
]


def curve_lines(curve: DataFrame, headers: DataFrame, axis: str) -> DataFrame:
    """``(fd_id, at, value)``; a curve without points gets its header only if it is a
    count curve."""
    heads = headers
    if axis == "mb":
        heads = headers.join(curve.select("fd_id").distinct(), "fd_id", "left_semi")
    head = heads.select(
        "fd_id",
        F.lit(None).cast("bigint").alias("at"),
        F.concat(
            F.lit("# "), F.concat_ws(" ", *[F.col(c) for c in CURVE_HEADER_FIELDS])
        ).alias("value"),
    )

    def one_digit(pct: str):
        return F.bround(F.col(pct), 1).cast("decimal(20,1)").cast("string")

    body = curve.select(
        "fd_id",
        F.col(axis).alias("at"),
        F.concat_ws(
            " ", axis, "requests", one_digit("request_pct"), "bytes", one_digit("byte_pct")
        ).alias("value"),
    )
    return head.unionByName(body)


def write_curve(
    curve: DataFrame, headers: DataFrame, path: str, axis: str = "mb", form: str = "parquet",
    mode: str = "errorifexists",
) -> DataFrame:
    """Write all curves below ``path``; returns the space curves refused as empty."""
    if form == "parquet":
        curve.write.mode(mode).parquet(path)
    elif form == "text":
        prefix = SPACE_PREFIX if axis == "mb" else COUNT_PREFIX
        write_lines(curve_lines(curve, headers, axis), path, prefix, mode)
    else:
        raise ValueError(f"unknown form {form!r}")
    refused = headers.join(curve.select("fd_id").distinct(), "fd_id", "left_anti")
    if axis != "mb":
        refused = refused.limit(0)
    return refused.select("fd_id", F.lit("empty curve").alias("reason"))


def read_curve(
    spark: SparkSession, path: str, axis: str = "mb", folders: bool = True
) -> DataFrame:
    """Points of curve files; percentages come back with the one digit written."""
    lines = read_lines(spark, path).filter(~F.col("value").startswith("#"))
    folder = F.regexp_extract("file", r"^(.*)/[^/]*$", 1)
    name = strip_key(folder_value(folder) if folders else base_name(F.col("file")))
    words = tokens(F.col("value"))
    return lines.select(
        F.regexp_replace(name, r"^std(space|count)\.", "").alias("fd_id"),
        integer(F.get(words, F.lit(0))).alias(axis),
        integer(F.get(words, F.lit(1))).alias("requests"),
        F.get(words, F.lit(2)).try_cast("double").alias("request_pct"),
        integer(F.get(words, F.lit(3))).alias("bytes"),
        F.get(words, F.lit(4)).try_cast("double").alias("byte_pct"),
    )
