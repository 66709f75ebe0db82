"""Lines of text files with their position, large files split over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# File name patterns of the text formats.
DESCRIPTOR_PREFIX = "stdtime."
SPACE_PREFIX = "stdspace."
COUNT_PREFIX = "stdcount."
KEY_SUFFIX = r"(?i)\.key(\d+)$"

# A position is block * 10^19 + line (a line number has at most 19 digits).
POSITION = "DECIMAL(18, 0)"
BLOCK_STEP = 10**19


def decoded(path: Column) -> Column:
    """File paths arrive URL-encoded; class names may contain ``^`` or ``+``.  Local
    paths come with one slash or with three."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def folder_value(path: Column) -> Column:
    """What a partition folder ``column=value`` stands for; its value is escaped the
    same way as a URL."""
    name = base_name(path)
    value = F.regexp_extract(name, r"^[^=]+=(.*)$", 1)
    return F.when(
        name.contains("="), F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    ).otherwise(name)


def strip_key(name: Column) -> Column:
    """File name without its encryption-key suffix."""
    return F.regexp_replace(name, KEY_SUFFIX, "")


def key_index(name: Column, default: str = "1") -> Column:
    found = F.regexp_extract(name, KEY_SUFFIX, 1)
    return F.when(found == "", F.lit(default)).otherwise(found)


def read_lines(
    spark: SparkSession, path: str | list[str], name_glob: str | None = None
) -> DataFrame:
    """``(file, pos, value)`` for every line below ``path``.

    A file larger than ``spark.sql.files.maxPartitionBytes`` is read by several
    tasks.  ``pos`` orders the lines of a file: start of the file block, then the
    running number inside the task that reads the block, as one number, so that
    aggregates can order by it without sorting.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    lines = reader.text(path).select(
        decoded(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    return lines.selectExpr(
        "file", f"CAST(block AS {POSITION}) * {BLOCK_STEP}BD + line AS pos", "value"
    )


def listed_files(
    spark: SparkSession, path: str | list[str], name_glob: str | None = None
) -> DataFrame:
    """``(file, length)`` of all files below ``path``, also of empty ones.

    The listing is read as a table, so names go to the tasks, not through the driver's code;
    it leaves out empty files, so names are fetched only where there are more files than it
    has.
    """
    def reader(form: str):
        found = spark.read.format(form).option("recursiveFileLookup", True)
        return found.option("pathGlobFilter", name_glob) if name_glob else found

    listed = reader("binaryFile").load(path).select(
        decoded(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_size").alias("length"))
    every = reader("text").load(path)
    if listed.count() == len(every._jdf.inputFiles()):
        return listed
    names = spark.createDataFrame([(f,) for f in every.inputFiles()], "name string")
    named = names.select(decoded(F.col("name")).alias("file"))
    return named.join(listed, "file", "left").select("file", F.coalesce("length", F.lit(0)).alias("length"))


def tokens(line: Column) -> Column:
    return F.split(F.trim(line), r"\s+")


def integer(token: Column) -> Column:
    return token.try_cast("bigint")
