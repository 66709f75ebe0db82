"""User-level jobs: text files in, tables or text files out, rejects reported.

Every job handles all files of its input in one Spark plan; with ``folders`` each folder
of part files is one descriptor, as the text writer leaves them.  ``Outcome.summary``
counts results and failures; ``Outcome.failures`` names them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.model import HEADER_COLS, Descriptors
from spoor.operators import curves, mix, transform
from spoor.operators.concat import above_limit, concat
from spoor.operators.summary import run_summary
from spoor.operators.transform import linked
from spoor.session import materialize
from spoor.sources.curves import write_curve
from spoor.sources.descriptors import Scanned, read_descriptors, write_descriptors
from spoor.sources.lines import read_lines
from spoor.sources.rules import Rules, read_concat_rules, read_mix_rules, rules_from_customer_map


class JobFailed(RuntimeError):
    """Some inputs of a job that must not fail could not be used."""


@dataclass(frozen=True)
class Outcome:
    summary: DataFrame
    failures: DataFrame


def _stored(d: Descriptors, label: str) -> Descriptors:
    return Descriptors(
        materialize(d.headers.select(HEADER_COLS), f"{label}-headers"),
        materialize(d.rows, f"{label}-rows"),
    )


def _named_failures(frame: DataFrame, name: str, detail: str = "reason") -> DataFrame:
    return frame.select(F.col(name).alias("name"), F.col(detail).alias("reason"))


def _finish(done: DataFrame, failures: DataFrame, strict: bool) -> Outcome:
    failures = materialize(failures, "failures")
    if strict and not failures.isEmpty():
        shown = ", ".join(f"{r['name']} ({r['reason']})" for r in failures.limit(10).collect())
        raise JobFailed(f"failed inputs, the first ones: {shown}")
    return Outcome(run_summary(done, failures), failures)


def mix_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    rules_path: str | None = None,
    customer_map: str | None = None,
    mix_id: str | None = None,
    thin_pct: float = 0.0,
    form: str = "parquet",
    in_rule_order: bool = False,
    compat_float32: bool = False,
    folders: bool = False,
) -> Outcome:
    """Mix the descriptors below ``input_path`` by rule files or by a customer map.

    A rule file with a bad line fails; a member that is unreadable, missing, without a
    rate to scale, scaled by 0 or empty is reported and left out of its mixes; a mix
    without traffic is not written.
    """
    if (rules_path is None) == (customer_map is None):
        raise ValueError("give either rule files or a customer map")
    if customer_map is not None:
        table = rules_from_customer_map(read_lines(spark, customer_map))
        given = Rules(table, None)
    else:
        given = read_mix_rules(spark, rules_path, mix_id)
    rules = materialize(given.rules, "rules")
    scanned = read_descriptors(spark, input_path, folders=folders)
    d = _stored(scanned.descriptors, "scanned")
    if compat_float32:
        d = transform.float32_traffic(d)
    d = Descriptors(d.headers, materialize(linked(d.rows), "scanned-linked"))
    combine = mix.mix_in_rule_order if in_rule_order else mix.mix
    result = _stored(combine(rules, d, compat_float32=compat_float32), "mixed")
    refused = write_descriptors(result, output_path, thin_pct, form)

    failures = _named_failures(refused, "fd_id").unionByName(
        _named_failures(scanned.rejects, "fd_id")
    ).unionByName(
        mix.missing_members(rules, d.headers).select(
            F.concat_ws("/", "mix_id", "fd_id").alias("name"),
            F.lit("no such descriptor").alias("reason"),
        )
    ).unionByName(
        mix.members(rules, d.headers, compat_float32).filter("status <> 'ok'").select(
            F.concat_ws("/", "mix_id", "fd_id").alias("name"), F.col("status").alias("reason")
        )
    )
    if given.rejects is not None:
        failures = failures.unionByName(_named_failures(given.rejects, "mix_id"))
    return _finish(result.headers, failures, strict=False)


def curve_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    axis: str = "mb",
    include_transitions: bool = False,
    quota: curves.Quota = curves.Quota(),
    form: str = "parquet",
    strict: bool = True,
    folders: bool = False,
) -> Outcome:
    """Hit-rate curves by size (``mb``) or object count (``objcount``) of one descriptor
    file or of all below a folder.  Results are written before failures raise."""
    scanned = read_descriptors(spark, input_path, folders=folders, default_key="2")
    d = _stored(scanned.descriptors, "scanned")
    make = curves.space_curve if axis == "mb" else curves.count_curve
    curve = materialize(make(d, include_transitions, quota), "curve")
    refused = write_curve(curve, d.headers, output_path, axis, form)
    failures = _named_failures(refused, "fd_id").unionByName(
        _named_failures(scanned.rejects, "fd_id")
    )
    return _finish(d.headers.join(refused, "fd_id", "left_anti"), failures, strict)


def unshard_job(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    factor: float,
    form: str = "parquet",
    compat_float32: bool = False,
    strict: bool = True,
    folders: bool = False,
) -> Outcome:
    """Multiply every amount of the descriptors below ``input_path``."""
    scanned = read_descriptors(spark, input_path, folders=folders)
    result = transform.unshard(_stored(scanned.descriptors, "scanned"), factor, compat_float32)
    refused = write_descriptors(result, output_path, form=form)
    failures = _named_failures(refused, "fd_id").unionByName(
        _named_failures(scanned.rejects, "fd_id")
    )
    return _finish(result.headers, failures, strict)


def concat_job(
    spark: SparkSession,
    input_path: str,
    rules_path: str,
    output_path: str,
    concat_id: str = "mix",
    weigh_by_traffic: bool = False,
    cmax: int = 0,
    min_ghost: int = 1,
    thin_pct: float = 0.0,
    form: str = "parquet",
    strict: bool = True,
    folders: bool = False,
) -> Outcome:
    """Concatenate the descriptors named in a rule file."""
    rules = read_concat_rules(spark, rules_path, concat_id)
    table = materialize(rules.rules, "concat-rules")
    scanned: Scanned = read_descriptors(spark, input_path, folders=folders)
    d = _stored(scanned.descriptors, "scanned")
    result = _stored(concat(table, d, weigh_by_traffic, cmax, min_ghost), "concatenated")
    refused = write_descriptors(result, output_path, thin_pct, form)
    absent = table.join(d.headers.select("fd_id"), "fd_id", "left_anti").select(
        F.concat_ws("/", "concat_id", "fd_id").alias("name"),
        F.lit("no such descriptor").alias("reason"),
    )
    failures = (
        _named_failures(refused, "fd_id")
        .unionByName(absent)
        .unionByName(_named_failures(scanned.rejects, "fd_id"))
        .unionByName(_named_failures(rules.rejects, "concat_id"))
    )
    if cmax > 0:
        cut = above_limit(table, d, cmax).select(
            F.col("concat_id").alias("name"),
            F.format_string("above the limit of %d mb: %d rows, %d bytes", F.lit(cmax), "rows",
                            "bytes").alias("reason"),
        )
        # what the caller asked to be left out is told, and fails nothing
        outcome = _finish(result.headers, failures, strict)
        told = materialize(outcome.failures.unionByName(cut), "failures-and-cuts")
        return Outcome(outcome.summary, told)
    return _finish(result.headers, failures, strict)
