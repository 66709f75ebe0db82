"""Session settings and shared-folder tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("spoor")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in
    ``spark.checkpoint.dir``; a fresh temporary one only where driver and executors are
    one process.  Raises if a cluster names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(
            "intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    folder = tempfile.mkdtemp(prefix="spoor-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: The folder inside the shared one that tables go to; None: that of the application.
_RUN: ContextVar[str | None] = ContextVar("spoor-run", default=None)


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/spoor-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """An unused path in the shared folder, below the folder of the run."""
    return f"{_RUN.get() or _application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder, whatever file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def run_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """Tables stored inside the block go to a folder of their own, which is removed at its
    end, whether it ends well or not.  For work whose result lies elsewhere by then."""
    folder = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        removed(spark, folder)


@contextmanager
def application_folder() -> Iterator[None]:
    """Tables stored inside the block stay until :func:`cleared`, also inside a run."""
    token = _RUN.set(None)
    try:
        yield
    finally:
        _RUN.reset(token)


def cleared(spark: SparkSession) -> None:
    """Remove the tables that queries of this application stored outside any run folder;
    their results must have been read or written before."""
    removed(spark, _application_folder(spark))


@contextmanager
def _without_old_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go as soon as it is written."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Stored:
    """A table in the shared folder, which may be dropped once nothing refers to it."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        removed(self.df.sparkSession, self.path)


def store(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> Stored:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive an executor, so a table read by
    several later steps is computed once, and its size is known when they are
    planned.  ``by`` names columns to lay the files out by, for steps that read a
    part each.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    with _without_old_shuffles(spark):
        df.write.partitionBy(*by).parquet(path) if by else df.write.parquet(path)
    return Stored(spark.read.schema(df.schema).parquet(path), path)


def materialize(df: DataFrame, label: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The table that ``store`` writes, for as long as the run lasts."""
    return store(df, label, by).df
