"""Registered queries that go through files: readers, writers and jobs.

The files are written by Spark from the descriptors and tables at hand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.model import HEADER_COLS, ROW_COLS, Descriptors
from spoor.operators import curves, summary
from spoor.plans import jobs
from spoor.session import new_path
from spoor.sources import curves as curve_files
from spoor.sources.descriptors import (
    descriptor_lines,
    read_descriptors,
    read_tables,
    write_descriptors,
    write_flat,
    write_lines,
)
from spoor.sources.rules import parse_concat_rules, parse_mix_rules
from workload import fixtures as fx
from workload.oracle import THIN_PCT

Query = Callable[[SparkSession, str], DataFrame]


def _text(spark: SparkSession, sf: str, source: str) -> str:
    """A folder of descriptor files of a log."""
    path = new_path(spark, "text")
    write_descriptors(fx.descriptors(spark, sf, source), path, form="text")
    return path


def _shards(spark: SparkSession, sf: str) -> DataFrame:
    """Files that hold every descriptor twice, one behind the other, headers included."""
    path = new_path(spark, "shards")
    lines = descriptor_lines(fx.descriptors(spark, sf, "lineitem"))
    second = lines.withColumn("at", F.col("at") + (1 << 40))
    write_lines(lines.unionByName(second), path, "stdtime.", "errorifexists")
    return read_descriptors(spark, path, folders=True).descriptors.rows


def _faults(spark: SparkSession, sf: str) -> DataFrame:
    """Why files with one fault each are refused; the others are read."""
    path = new_path(spark, "faults")
    lines = descriptor_lines(fx.descriptors(spark, sf, "lineitem"))
    head = F.col("at") < 0
    broken = lines.select("fd_id", "at", F.expr(
        "CASE WHEN fd_id = 'g0' AND at < 0 THEN substring(value, 3, 1000)"
        " WHEN fd_id = 'g1' AND at < 0 THEN '# 0 0 5'"
        " WHEN fd_id = 'g2' AND at > 0 AND at % 2 = 1 THEN concat(substring_index(value, ' ', 6), ' x')"
        " WHEN fd_id = 'g4' AND at < 0 THEN '# 1 2' ELSE value END").alias("value"))
    write_lines(broken.filter(head | (F.col("fd_id") != "g3")), path, "stdtime.", "errorifexists")
    return read_descriptors(spark, path, folders=True).rejects.select("fd_id", "reason")


def _key_names(spark: SparkSession, sf: str) -> DataFrame:
    """Every second file is named with a key."""
    path = new_path(spark, "keys")
    d = fx.descriptors(spark, sf, "lineitem")
    n = "CAST(substring(fd_id, 2) AS INT)"
    named = f"if({n} % 2 = 0, concat(fd_id, '.key', {n}), fd_id) AS fd_id"
    lines = descriptor_lines(d).selectExpr(named, "at", "value")
    write_lines(lines, path, "stdtime.", "errorifexists")
    return read_descriptors(spark, path, folders=True).files.select("fd_id", "key_index")


def _curve(source: str, axis: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        d, path = fx.descriptors(spark, sf, source), new_path(spark, "curves")
        make = curves.space_curve if axis == "mb" else curves.count_curve
        curve_files.write_curve(make(d), d.headers, path, axis, "text")
        return curve_files.read_curve(spark, path, axis)

    return run


def _rule_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of four rule files from the suppliers; the file ``bad`` has wrong lines only."""
    return fx.table(spark, sf, "supplier").selectExpr(
        "if(s_suppkey % 7 = 0, 'bad', concat('m', s_suppkey % 3)) AS mix_id",
        "s_suppkey AS pos",
        "concat('g', s_nationkey, CASE WHEN s_suppkey % 14 = 0 THEN ' multiply 2'"
        " WHEN s_suppkey % 7 = 0 THEN ' add much' WHEN s_suppkey % 5 = 0 THEN ' add 0.5'"
        " WHEN s_suppkey % 5 = 1 THEN ' SUB 2G' WHEN s_suppkey % 5 = 2 THEN '  add 3M 2/16'"
        " WHEN s_suppkey % 5 = 3 THEN ' add 1.5 0/0 100 5 7 2' ELSE '' END) AS value",
    ).withColumn("value", F.expr("if(value rlike ' ', value, '# nothing')"))


def _concat_lines(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "supplier").selectExpr(
        "'all' AS concat_id", "s_suppkey AS pos",
        "concat('g', s_nationkey, ' ', CAST(s_suppkey AS DOUBLE) / 4) AS value")


def _rule_file(spark: SparkSession, lines: list[str]) -> str:
    path = new_path(spark, "rule-file")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def _mix_job(spark: SparkSession, sf: str) -> tuple[Descriptors, jobs.Outcome]:
    lines = [f"{r[2]} {r[3]} {_scale(r)}" + (f" {r[6]}/{r[7]}" if r[7] else "") for r in fx.JOB_RULES]
    out = new_path(spark, "mix-job")
    outcome = jobs.mix_job(spark, _text(spark, sf, "events"), out, _rule_file(spark, lines),
                           mix_id="job", folders=True)
    return read_tables(spark, out), outcome


def _scale(r: tuple) -> str:
    return f"{r[4] / 1000}K" if r[5] == "traffic" else str(r[4])


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    """One file per descriptor, with a key, beside files of other names; read back by the
    name's glob."""
    path, d = new_path(spark, "flat"), fx.descriptors(spark, sf, "lineitem")
    write_descriptors(d, path, form="flat", key="3")
    write_flat(descriptor_lines(d), path, "other.")
    return read_descriptors(spark, path, "stdtime.g1*").descriptors.rows


def _networks(spark: SparkSession, sf: str) -> Descriptors:
    """The events classes as classes of two networks."""
    d = fx.descriptors(spark, sf, "events")
    name = "concat(if(fd_id IN ('click', 'view'), 'a', 'b^x'), '^', fd_id) AS fd_id"
    return Descriptors(d.headers.selectExpr(name, *HEADER_COLS[1:]), d.rows.selectExpr(name, *ROW_COLS[1:]))


def _customer_map_job(spark: SparkSession, sf: str) -> DataFrame:
    """A mix per network, from a map that names a class of it in every line."""
    path, out, where = new_path(spark, "nets"), new_path(spark, "mix-job"), new_path(spark, "map")
    write_descriptors(_networks(spark, sf), path, form="flat")
    names = "array('a^click', 'a^view', 'b^x^error', 'b^x^signup', 'b^x^purchase', 'plain')"
    lines = fx.table(spark, sf, "nation").selectExpr(
        f"concat_ws(' ', n_nationkey, n_regionkey, 'x', {names}[n_nationkey % 6]) AS value")
    lines.write.text(where)
    jobs.mix_job(spark, path, out, customer_map=where)
    return read_tables(spark, out).rows.select(ROW_COLS)


def _glob_job(spark: SparkSession, sf: str) -> DataFrame:
    """Rule files by glob, results thinned and written flat; a file of another name is left."""
    path, out = new_path(spark, "rules"), new_path(spark, "mix-job")
    lines = [(m, i, f"{c} add {s}") for m, s in (("half.mg", 0.5), ("one.mg", 1.0), ("other", 1.0))
             for i, c in enumerate(fx.EVENT_CLASSES)]
    write_flat(spark.createDataFrame(lines, "fd_id string, at int, value string"), path, "")
    jobs.mix_job(spark, _text(spark, sf, "events"), out, f"{path}/*.mg", thin_pct=THIN_PCT, form="flat",
                 folders=True)
    return read_descriptors(spark, out).descriptors.rows


def _job_of_many_faults(spark: SparkSession, sf: str) -> DataFrame:
    """Each reason for which a mix job leaves something out, once."""
    path, out, rules = (new_path(spark, x) for x in ("faulty", "mix-job", "rules"))
    events, more = fx.descriptors(spark, sf, "events"), fx.descriptors(spark, sf, "lineitem")
    write_flat(descriptor_lines(events), f"{path}/b", "stdtime.")
    write_flat(descriptor_lines(events.named("click")), f"{path}/a", "stdtime.")
    broken = descriptor_lines(more.named("g0", "g1", "g2", "g3", "g6")).select("fd_id", "at", F.expr(
        "CASE WHEN fd_id = 'g0' AND at < 0 THEN substring(value, 3, 1000)"
        " WHEN fd_id = 'g1' AND at < 0 THEN '# 0 0 5'"
        " WHEN fd_id = 'g2' AND at > 0 THEN substring_index(value, ' ', 6)"
        " WHEN fd_id = 'g6' AND at < 0 THEN '# 100000000 9 0' ELSE value END").alias("value"))
    write_flat(broken.filter("at < 0 OR fd_id <> 'g3'"), f"{path}/b", "stdtime.")
    lines = [("job", i, x) for i, x in enumerate((
        "click add 2", "absent add 1", "purchase add 0", "g6 add 50K", "error add 0.0000000001"))]
    lines.append(("bad", 0, "click multiply 2"))
    write_flat(spark.createDataFrame(lines, "fd_id string, at int, value string"), rules, "")
    return jobs.mix_job(spark, path, out, rules).failures


def _unshard_job(spark: SparkSession, sf: str) -> DataFrame:
    out = new_path(spark, "unshard-job")
    jobs.unshard_job(spark, _text(spark, sf, "events"), out, 2.5, folders=True)
    return read_tables(spark, out).rows.select(ROW_COLS)


def _curve_job(source: str, axis: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = new_path(spark, "curve-job")
        jobs.curve_job(spark, _text(spark, sf, source), out, axis, folders=True)
        return spark.read.parquet(out)

    return run


def _concat_job(spark: SparkSession, sf: str) -> DataFrame:
    out = new_path(spark, "concat-job")
    rules = _rule_file(spark, [f"{r[2]} {r[3]}" for r in fx.CONCAT if r[0] == "three"])
    jobs.concat_job(spark, _text(spark, sf, "events"), rules, out, "three", folders=True)
    return read_tables(spark, out).rows.select(ROW_COLS)


def all_queries() -> dict[str, Query]:
    return {
        "read_shards": _shards,
        "read_rejects": _faults,
        "read_key_names": _key_names,
        "curve_files_space": _curve("events", "mb"),
        "curve_files_count": _curve("lineitem", "objcount"),
        "mix_rules_parsed": lambda s, sf: parse_mix_rules(_rule_lines(s, sf)).rules,
        "mix_rules_rejects": lambda s, sf: parse_mix_rules(_rule_lines(s, sf)).rejects,
        "concat_rules_parsed": lambda s, sf: parse_concat_rules(_concat_lines(s, sf)).rules,
        "preview": lambda s, sf: summary.preview(
            fx.descriptors(s, sf, "lineitem").headers, ["total_served_bytes", "fd_id"], 5),
        "unshard_job": _unshard_job,
        "t2s_job": _curve_job("events", "mb"),
        "t2c_job": _curve_job("lineitem", "objcount"),
        "concat_job": _concat_job,
        "mix_job": lambda s, sf: _mix_job(s, sf)[0].rows.select(ROW_COLS),
        "mix_job_failures": lambda s, sf: _mix_job(s, sf)[1].failures,
        "mix_job_faults": _job_of_many_faults,
        "mix_job_customer_map": _customer_map_job,
        "mix_job_glob_thinned": _glob_job,
        "flat_files": _flat,
    }
