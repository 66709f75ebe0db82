"""Text form of descriptors: reader with quarantine, and writer.

A file holds one descriptor: a header line ``# requests bytes duration [mib [objects
bytes [peak_requests peak_bytes]]]`` and body lines of seven integers ``delta_t mb
objcount requests bytes tr_bytes tr_requests``.  A file made of shards repeats the
header and the body lines; its first header counts and its rows add up.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.functions.numeric import aggregates
from spoor.model import HEADER_COLS, ROW_COLS, Descriptors
from spoor.operators.thin import thin
from spoor.operators.transform import coalesce_rows, validity
from spoor.session import materialize, removed
from spoor.sources.lines import (
    DESCRIPTOR_PREFIX,
    KEY_SUFFIX,
    base_name,
    folder_value,
    integer,
    key_index,
    listed_files,
    read_lines,
    strip_key,
    tokens,
)

# Order of the numbers in a header line and in a body line.
HEADER_FIELDS = [
    "total_requests",
    "total_served_bytes",
    "duration",
    "total_mib",
    "unique_objects",
    "unique_bytes",
    "peak_requests_300s",
    "peak_bytes_300s",
]
BODY_FIELDS = ["delta_t", "mb", "objcount", "requests", "bytes", "tr_bytes", "tr_requests"]
HEADER_REQUIRED = 3


@dataclass(frozen=True)
class Scanned:
    """Descriptors that could be read, and the files that could not with a reason."""

    descriptors: Descriptors
    rejects: DataFrame
    files: DataFrame


def read_descriptors(
    spark: SparkSession,
    path: str | list[str],
    name_glob: str = "stdtime*",
    folders: bool = False,
    default_key: str = "1",
) -> Scanned:
    """Every descriptor file below ``path``.

    The class name is the file name without ``stdtime.`` and ``.keyN``; with
    ``folders`` it is that of the folder, whose part files form one descriptor (the
    layout :func:`write_descriptors` produces).  Where two files hold the same
    class, the last one by path counts and the others are reported.
    """
    glob = None if folders else name_glob
    lines = read_lines(spark, path, glob)
    seen = listed_files(spark, path, glob).select("file")
    if folders:
        # the part files of a folder follow each other in number order
        part = r"coalesce(try_cast(regexp_extract(file, '/part-(\\d+)[^/]*$', 1) AS BIGINT), 0)"
        lines = lines.selectExpr(
            "regexp_extract(file, '^(.*)/[^/]*$', 1) AS file",
            f"named_struct('part', {part}, 'at', pos) AS pos",
            "value",
        )
        seen = seen.selectExpr("regexp_extract(file, '^(.*)/[^/]*$', 1) AS file").distinct()
        named = folder_value(F.col("file"))
    else:
        named = base_name(F.col("file"))

    words = tokens(F.col("value"))
    body = [integer(F.get(words, F.lit(i))).alias(c) for i, c in enumerate(BODY_FIELDS)]
    parsed = lines.select(
        "file", "pos", "value", F.col("value").startswith("#").alias("is_head"), *body
    )
    whole = " AND ".join(f"{c} IS NOT NULL" for c in BODY_FIELDS)
    # one pass over the text tells all about a file; its first line is its header
    numbers = F.transform(tokens(F.regexp_replace("head", "^#", "")), integer)
    per_file = (
        parsed.groupBy("file")
        .agg(
            *aggregates({
                "body_rows": "count_if(NOT is_head)",
                "bad_rows": f"count_if(NOT is_head AND NOT ({whole}))",
                "first_pos": "min(pos)",
                "first_head": "min(if(is_head, pos, NULL))",
                "head": "min_by(value, pos) FILTER (WHERE is_head)",
            })
        )
        .withColumn("numbers", F.coalesce(numbers, F.array().cast("array<bigint>")))
        .selectExpr(
            "*",
            "coalesce(nullif(array_position(transform(numbers, x -> x IS NULL), true), 0) - 1, "
            "size(numbers)) AS given",
        )
        .selectExpr(
            "file",
            "body_rows",
            "bad_rows",
            "coalesce(first_pos = first_head, false) AS marked",
            "given",
            *[f"if(given > {i}, get(numbers, {i}), 0L) AS {c}" for i, c in enumerate(HEADER_FIELDS)],
        )
    )
    files = (
        seen.withColumn("file_name", named)
        .withColumn("fd_id", F.regexp_replace(strip_key(F.col("file_name")), r"^stdtime\.", ""))
        .withColumn("key_index", key_index(F.col("file_name"), default_key))
    )
    latest = files.groupBy("fd_id").agg(F.max("file").alias("latest"))
    # stored: the headers, the rejects and the rows all refer to it, and it takes a pass
    # over the text to make
    judged = materialize(
        files.join(latest, "fd_id")
        .join(per_file, "file", "left")
        .selectExpr(
            "*",
            "CASE WHEN file <> latest THEN 'superseded'"
            " WHEN body_rows IS NULL THEN 'empty'"
            f" WHEN NOT marked OR given < {HEADER_REQUIRED} THEN 'bad header'"
            " WHEN total_requests <= 0 OR total_served_bytes <= 0 THEN 'no traffic'"
            " WHEN bad_rows > 0 THEN 'bad line'"
            " WHEN body_rows = 0 THEN 'no body' END AS reason",
        ),
        "descriptor-files",
    )
    good = judged.filter("reason IS NULL")
    rows = coalesce_rows(
        parsed.filter("NOT is_head").join(good.select("file", "fd_id"), "file"), "pos"
    ).select(ROW_COLS)
    return Scanned(
        Descriptors(good.select(HEADER_COLS), rows),
        judged.filter("reason IS NOT NULL").select("fd_id", "file", "reason"),
        judged.select("fd_id", "file", "key_index", "reason"),
    )


def descriptor_lines(d: Descriptors) -> DataFrame:
    """``(fd_id, at, value)``: the text lines of each descriptor, header at -1."""
    head = d.headers.select(
        "fd_id",
        F.lit(-1).cast("bigint").alias("at"),
        F.concat(F.lit("# "), F.concat_ws(" ", *[F.col(c) for c in HEADER_FIELDS])).alias("value"),
    )
    body = d.rows.select(
        "fd_id",
        F.col("delta_t").alias("at"),
        F.concat_ws(" ", *[F.col(c) for c in BODY_FIELDS]).alias("value"),
    )
    return head.unionByName(body)


def writable(d: Descriptors) -> tuple[Descriptors, DataFrame]:
    """Descriptors fit for writing, and the rejects.  Empty ones are skipped in
    silence, invalid ones are reported."""
    state = validity(d)
    fit = state.filter("is_valid AND NOT is_empty").select("fd_id")
    unfit = state.filter("NOT is_valid AND NOT is_empty").select(
        "fd_id", F.lit("invalid descriptor").alias("reason")
    )
    return (
        Descriptors(d.headers.join(fit, "fd_id", "left_semi").select(HEADER_COLS),
                    d.rows.join(fit, "fd_id", "left_semi").select(ROW_COLS)),
        unfit,
    )


def write_descriptors(
    d: Descriptors, path: str, thin_pct: float = 0.0, form: str = "parquet",
    mode: str = "errorifexists", key: str | None = None,
) -> DataFrame:
    """Write all valid descriptors below ``path``; returns the rejects.

    ``parquet`` keeps two tables, ``headers`` and ``rows``.  ``text`` makes a folder
    ``name=stdtime.<class>`` per descriptor; the range partitioning lets several
    tasks write a long one, its part files follow each other in name order.  ``flat`` makes
    one file ``stdtime.<class>`` per descriptor, with ``.key<n>`` behind it if ``key`` is given,
    as the command-line tools read them.
    """
    fit, rejects = writable(d)
    fit = Descriptors(fit.headers, thin(fit.rows, thin_pct))
    if form == "parquet":
        fit.headers.write.mode(mode).parquet(f"{path}/headers")
        fit.rows.write.mode(mode).parquet(f"{path}/rows")
    elif form == "text":
        write_lines(descriptor_lines(fit), path, DESCRIPTOR_PREFIX, mode)
    elif form == "flat":
        write_flat(descriptor_lines(fit), path, DESCRIPTOR_PREFIX, key)
    else:
        raise ValueError(f"unknown form {form!r}")
    return rejects


def write_lines(lines: DataFrame, path: str, prefix: str, mode: str) -> None:
    """One folder per descriptor, its part files following each other.

    The order is by the column the folders are made of: an order by another one would
    not be kept by the write.
    """
    (
        lines.select(F.concat(F.lit(prefix), "fd_id").alias("name"), "at", "value")
        .repartitionByRange("name", "at")
        .sortWithinPartitions("name", "at")
        .select("name", "value")
        .write.mode(mode)
        .partitionBy("name")
        .text(path)
    )


def write_flat(lines: DataFrame, path: str, prefix: str, key: str | None = None) -> None:
    """One file per descriptor, straight below ``path``.

    A file has one writer: all lines of a name go to one task, which sorts (and spills) them
    and streams them out.  The part files are written to a folder beside the target and
    moved to their names once all of them are there, so a lost executor leaves no half of a
    file; a move touches names only.  Files of these names that are there are replaced.
    """
    spark = lines.sparkSession
    # not hidden, yet no name that a reader of descriptors looks for
    staged = f"{path.rstrip('/')}/staged-{uuid.uuid4().hex}"
    suffix = "" if key is None else f".key{key}"
    named = lines.select(F.concat(F.lit(prefix), "fd_id").alias("name"), "at", "value")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with_suffix = F.when(F.col("name").rlike(KEY_SUFFIX), F.col("name")).otherwise(
        F.concat("name", F.lit(suffix)))
    (
        named.withColumn("name", with_suffix)
        .repartition(parts, "name")
        .sortWithinPartitions("name", "at")
        .select("name", "value")
        .write.option("maxRecordsPerFile", 0)
        .partitionBy("name")
        .text(staged)
    )
    try:
        move_parts(spark, staged, path)
    finally:
        removed(spark, staged)


def move_parts(spark: SparkSession, staged: str, path: str) -> None:
    """Move ``name=<x>/part-...`` below ``staged`` to ``path/<x>``, several at a time."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(staged)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def moved(folder) -> None:
        name = unquote(folder.getName().split("=", 1)[1])
        parts = [f.getPath() for f in system.listStatus(folder) if f.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise ValueError(f"{name} was written in {len(parts)} parts")
        target = hadoop.Path(path, name)
        system.delete(target, False)
        if not system.rename(parts[0], target):
            raise OSError(f"could not move {name} to {path}")

    folders = [f.getPath() for f in system.listStatus(root) if f.isDirectory()]
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(moved, folders))


def read_tables(spark: SparkSession, path: str) -> Descriptors:
    """Descriptors written with ``form='parquet'``."""
    return Descriptors(
        spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/rows")
    )
