"""Rule files: mix rules, concat rules and rules generated from a customer map.

A mix rule line is ``class action scale[G|M|K] [n/m] [max_mb] [min_mb] [max_count]
[min_count]``; a scale with a suffix is a traffic target in bits/s.  Lines that start
with ``#`` are comments.  One bad line makes its whole file unusable.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoor.model import RULE_COLS
from spoor.sources.lines import base_name, listed_files, read_lines, strip_key, tokens

# Actions of a rule line and the factors of the traffic suffixes.
ACTIONS = ["add", "sub", "concat"]
SUFFIX_FACTORS = {"G": 1e9, "M": 1e6, "K": 1e3}
# Fixed value: the file that names the files of a bundled rule set.
MANIFEST = "MANIFEST"


@dataclass(frozen=True)
class Rules:
    rules: DataFrame
    rejects: DataFrame


def _usable(parsed: DataFrame, owner: str) -> tuple[DataFrame, DataFrame]:
    bad = parsed.filter("reason IS NOT NULL").select(owner, "value", "reason")
    return parsed.join(bad.select(owner).distinct(), owner, "left_anti"), bad


def _in_file_order(owner: str) -> Column:
    return (F.row_number().over(Window.partitionBy(owner).orderBy("pos")) - 1).cast("int")


def parse_mix_rules(lines: DataFrame) -> Rules:
    """Lines ``(mix_id, pos, value)`` -> rule table, and the lines that spoil a file."""
    words = tokens(F.col("value"))

    def word(i: int) -> Column:
        return F.get(words, F.lit(i))

    action, amount = F.lower(word(1)), word(2)
    suffix = F.regexp_extract(amount, "([A-Za-z])$", 1)
    number = F.regexp_replace(amount, "[A-Za-z]$", "").try_cast("double")
    target = F.lit(None).cast("double")
    for letter, factor in SUFFIX_FACTORS.items():
        target = F.when(suffix == letter, number * F.lit(factor)).otherwise(target)
    shards = F.split(word(3), "/")

    def count(x: Column, kind: str) -> Column:
        return F.coalesce(x.try_cast(kind), F.lit(0).cast(kind))

    parsed = lines.filter(~F.col("value").startswith("#")).select(
        "mix_id",
        "pos",
        "value",
        word(0).alias("fd_id"),
        action.alias("op"),
        F.when(suffix == "", number).otherwise(target).alias("scale"),
        F.when(suffix == "", "absolute").otherwise("traffic").alias("scale_type"),
        count(F.get(shards, F.lit(0)), "int").alias("num_shards"),
        count(F.get(shards, F.lit(1)), "int").alias("total_shards"),
        *[count(word(4 + i), "bigint").alias(c) for i, c in
          enumerate(["max_mb", "min_mb", "max_count", "min_count"])],
    ).withColumn(
        "reason",
        F.when(~F.coalesce(F.col("op").isin(ACTIONS), F.lit(False)), "bad action").when(
            F.col("scale").isNull(), "bad scale"
        ),
    )
    good, bad = _usable(parsed, "mix_id")
    return Rules(good.withColumn("ord", _in_file_order("mix_id")).select(RULE_COLS), bad)


def read_mix_rules(
    spark: SparkSession, path: str | list[str], mix_id: str | None = None
) -> Rules:
    """Rule files below ``path`` (a file, a folder or a glob).  The mix is called like
    its file without ``.keyN``; a single file may be given another name, and else
    loses a trailing ``.config`` as well.  Where two files have one name, the last one by
    path counts and the others are reported."""
    lines = read_lines(spark, path)
    name = strip_key(base_name(F.col("file")))
    single = isinstance(path, str) and not any(c in path for c in "*?[{")
    if mix_id is not None:
        name = F.lit(mix_id)
    elif single:
        name = F.regexp_replace(name, r"\.config$", "")
    return _latest(lines.filter(base_name(F.col("file")) != MANIFEST).select(
        name.alias("mix_id"), "file", "pos", "value"
    ))


def _latest(lines: DataFrame) -> Rules:
    """Lines ``(mix_id, file, pos, value)`` parsed; of files of one name the last by path."""
    files = lines.select("mix_id", "file").distinct()
    latest = files.groupBy("mix_id").agg(F.max("file").alias("latest"))
    older = files.join(latest, "mix_id").filter("file <> latest").select(
        "mix_id", F.col("file").alias("value"), F.lit("superseded").alias("reason")
    )
    parsed = parse_mix_rules(
        lines.join(latest, "mix_id").filter("file = latest").select("mix_id", "pos", "value")
    )
    return Rules(parsed.rules, parsed.rejects.unionByName(older))


@dataclass(frozen=True)
class Bundle:
    """Rule files named by a manifest; ``missing``: names it has and the folder hasn't."""

    rules: DataFrame
    rejects: DataFrame
    missing: DataFrame


def read_bundle(spark: SparkSession, folder: str) -> Bundle:
    """The rule files below ``folder`` that its ``MANIFEST`` names, one name a line (``#``:
    a comment).  A file it doesn't name is left alone.

    The listing is joined to the manifest before anything is read; a file without lines
    is an empty mix, not a missing one.
    """
    folder = folder.rstrip("/")
    named = spark.read.text(f"{folder}/{MANIFEST}").select(F.trim("value").alias("name")).filter(
        "name <> '' AND name NOT LIKE '#%'").distinct()
    there = listed_files(spark, folder).select(base_name(F.col("file")).alias("name")).distinct()
    missing = named.join(there, "name", "left_anti")
    lines = read_lines(spark, folder).withColumn("name", base_name(F.col("file")))
    lines = lines.join(named, "name", "left_semi").withColumn("mix_id", strip_key(F.col("name")))
    parsed = _latest(lines)
    return Bundle(parsed.rules, parsed.rejects, missing)


def write_mix_rules(rules: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of rules as a table, to be read back with ``spark.read.parquet``."""
    rules.select(RULE_COLS).write.mode(mode).parquet(path)


def rules_from_customer_map(lines: DataFrame) -> DataFrame:
    """Map lines ``(value)`` -> one mix per network: its classes in order, each ``add 1``.

    The fourth column names the class; the network is the part before its last ``^``.
    Lines with fewer columns or without ``^`` say nothing.  A class listed twice
    counts twice.
    """
    ext = F.get(tokens(F.col("value")), F.lit(3))
    named = lines.select(ext.alias("fd_id")).filter(F.col("fd_id").contains("^")).select(
        F.regexp_extract("fd_id", r"^(.*)\^[^^]*$", 1).alias("mix_id"), "fd_id"
    )
    order = F.row_number().over(Window.partitionBy("mix_id").orderBy("fd_id")) - 1
    zero = F.lit(0)
    return named.select(
        "mix_id",
        order.cast("int").alias("ord"),
        "fd_id",
        F.lit("add").alias("op"),
        F.lit(1.0).alias("scale"),
        F.lit("absolute").alias("scale_type"),
        zero.alias("num_shards"),
        zero.alias("total_shards"),
        *[zero.cast("bigint").alias(c) for c in ("max_mb", "min_mb", "max_count", "min_count")],
    )


def parse_concat_rules(lines: DataFrame) -> Rules:
    """Lines ``(concat_id, pos, value)`` of ``class scale`` -> concat rules."""
    words = tokens(F.col("value"))
    parsed = lines.filter(~F.col("value").startswith("#")).select(
        "concat_id",
        "pos",
        "value",
        F.get(words, F.lit(0)).alias("fd_id"),
        F.get(words, F.lit(1)).try_cast("double").alias("scale"),
    ).withColumn("reason", F.when(F.col("scale").isNull(), "bad scale"))
    good, bad = _usable(parsed, "concat_id")
    return Rules(
        good.withColumn("ord", _in_file_order("concat_id")).select(
            "concat_id", "ord", "fd_id", "scale"
        ),
        bad,
    )


def read_concat_rules(spark: SparkSession, path: str, concat_id: str = "mix") -> Rules:
    lines = read_lines(spark, path)
    return parse_concat_rules(lines.select(F.lit(concat_id).alias("concat_id"), "pos", "value"))


def describe_rules(rules: DataFrame) -> DataFrame:
    """One readable line per rule."""
    return rules.select(
        "mix_id",
        "ord",
        F.concat_ws(
            " ",
            "fd_id",
            F.concat(F.col("num_shards"), F.lit("/"), F.col("total_shards"), F.lit(" shards,")),
            "op",
            "scale",
        ).alias("rule"),
    )
