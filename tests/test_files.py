"""What the writers, jobs and the shared folder promise."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from spoor.operators.concat import above_limit, concat
from spoor.plans import jobs
from spoor.session import shared_folder
from spoor.sources.rules import read_mix_rules
from helpers import make

SPILLING = """
import sys
from pyspark.sql import SparkSession, functions as F
from spoor.sources.descriptors import write_lines
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.shuffle.spill.numElementsForceSpillThreshold", "1000")
         .config("spark.sql.shuffle.partitions", "5").getOrCreate())
lines = spark.range(60000).selectExpr("concat('c', id % 3) AS fd_id",
    "(id * 7919) % 60000 - 1 AS at", "CAST((id * 7919) % 60000 - 1 AS STRING) AS value")
write_lines(lines, sys.argv[1], "stdtime.", "errorifexists")
"""


def test_lines_stay_in_order_when_sorts_spill(tmp):
    out = f"{tmp}/text"
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    subprocess.run([sys.executable, "-c", SPILLING, out], check=True, env=env, timeout=300,
                   capture_output=True)
    seen = 0
    for folder in sorted(x for x in os.listdir(out) if x.startswith("name=")):
        parts = sorted(x for x in os.listdir(f"{out}/{folder}") if x.startswith("part-"))
        numbers = [int(n) for p in parts for n in open(f"{out}/{folder}/{p}")]
        assert numbers == sorted(numbers)
        seen += len(numbers)
    assert seen == 60000


def test_a_cluster_without_shared_folder_fails_at_once():
    spark = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: None),
                            sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(spark)


@pytest.fixture
def pair(spark):
    return make(spark, {"a": [(1, 5, 1, 10, 100, 1, 1), (9, 50, 2, 20, 200, 2, 2)],
                        "b": [(2, 8, 1, 10, 100, 1, 1)]})


def test_no_limit_unless_asked_and_what_it_leaves_out(spark, pair):
    rules = spark.createDataFrame([("m", 0, "a", 1.0), ("m", 1, "b", 1.0)],
                                  "concat_id string, ord int, fd_id string, scale double")
    total = lambda d: d.rows.selectExpr("sum(bytes)").first()[0]
    assert total(concat(rules, pair)) == 400
    assert total(concat(rules, pair, cmax=10)) == 200
    assert [tuple(r) for r in above_limit(rules, pair, 10).collect()] == [("m", 1, 202)]


def test_equal_rule_file_names_are_reported(spark, tmp):
    for folder, line in (("x", "a add 1"), ("y", "b add 2")):
        os.makedirs(f"{tmp}/{folder}")
        with open(f"{tmp}/{folder}/g0", "w") as f:
            f.write(line + "\n")
    found = read_mix_rules(spark, tmp)
    assert [(r["mix_id"], r["fd_id"]) for r in found.rules.collect()] == [("g0", "b")]
    assert [(r["mix_id"], r["reason"]) for r in found.rejects.collect()] == [("g0", "superseded")]


def test_concat_job_reports_broken_files_and_cuts(spark, pair, tmp):
    from spoor.sources.descriptors import descriptor_lines, write_lines

    lines = descriptor_lines(pair).unionByName(
        spark.createDataFrame([("c", -1, "no header")], "fd_id string, at long, value string"))
    write_lines(lines, f"{tmp}/in", "stdtime.", "errorifexists")
    with open(f"{tmp}/rules", "w") as f:
        f.write("a 1\nb 1\n")
    done = jobs.concat_job(spark, f"{tmp}/in", f"{tmp}/rules", f"{tmp}/out", cmax=10, strict=False,
                           folders=True)
    got = {r["name"]: r["reason"] for r in done.failures.collect()}
    assert got == {"c": "bad header", "mix": "above the limit of 10 mb: 1 rows, 202 bytes"}


def test_left_out_classes_and_lines_are_named(spark):
    from spoor.operators.transform import scale_to_traffic, stretch_duration, without_rate
    from spoor.streaming.accesslog import broken_lines, parse_lines

    body = [(1, 5, 1, 10, 100, 1, 1)]
    d = make(spark, {"a": body, "b": body, "c": body},
             {"b": {"duration": 0}, "c": {"total_served_bytes": 1, "duration": 100}})
    kept = {r["fd_id"] for r in scale_to_traffic(d, 50.0).headers.collect()}
    assert {r["fd_id"]: r["reason"] for r in without_rate(d).collect()} == {"b": "duration 0", "c": "no rate"}
    assert kept == {"a"}
    assert [r["fd_id"] for r in without_rate(d, duration_only=True).collect()] == ["b"]
    assert {r["fd_id"] for r in stretch_duration(d, 50).headers.collect()} == {"a", "c"}
    lines = spark.createDataFrame(
        [("k:5:obj:1:2:0:cls:0",), ("k:x:obj:1:2:0:cls:0",), ("k:5:obj:1:y:0:cls:0",), ("short",)], "value string")
    assert [tuple(r) for r in parse_lines(lines).collect()] == [("cls", "obj", 5, 2)]
    assert sorted(r["reason"] for r in broken_lines(lines).collect()) == ["bad size", "bad time", "too few fields"]


def names_below(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


def test_a_run_leaves_nothing_behind(spark, tmp, monkeypatch):
    from spoor import session

    monkeypatch.setattr(session, "shared_folder", lambda _: tmp)
    monkeypatch.setattr(session, "_application_folder", lambda _: f"{tmp}/application")
    with session.run_folder(spark, "run"):
        session.materialize(spark.range(5), "one")
        assert names_below(tmp)
        with session.application_folder():
            kept = session.materialize(spark.range(5), "two")
    assert {x.split("/")[0] for x in names_below(tmp)} == {"application"} and kept.count() == 5
    stored = session.store(spark.range(5), "three")
    stored.drop()
    assert not any("three" in x for x in names_below(tmp))
    session.cleared(spark)
    assert names_below(tmp) == []


def test_a_job_leaves_only_its_result(spark, tmp, monkeypatch):
    from spoor import __main__ as command, session
    from spoor.sources.descriptors import write_descriptors

    monkeypatch.setattr(session, "shared_folder", lambda _: f"{tmp}/shared")
    monkeypatch.setattr(session, "_application_folder", lambda _: f"{tmp}/shared/application")
    d = make(spark, {"a": [(1, 5, 1, 10, 100, 0, 0), (4, 9, 2, 5, 50, 0, 0)]})
    with session.run_folder(spark, "input"):
        write_descriptors(d, f"{tmp}/in", form="flat", key="2")
    assert [x for x in names_below(f"{tmp}/in") if not x.startswith(".")] == ["stdtime.a.key2"]
    args = command.parser().parse_args(
        ["unshard", "--input", f"{tmp}/in", "--output", f"{tmp}/out", "--factor", "2", "--form", "flat"])
    with session.run_folder(spark, "job"):
        assert command.run(spark, args).failures.count() == 0
    assert names_below(f"{tmp}/shared") == []
    assert [x for x in names_below(f"{tmp}/out") if not x.startswith(".")] == ["stdtime.a"]
    with open(f"{tmp}/out/stdtime.a") as f:
        lines = f.read().splitlines()
    assert lines[0].startswith("# ") and lines[1:] == ["1 10 2 20 200 0 0", "4 18 4 10 100 0 0"]


def test_a_bundle_reads_what_its_manifest_names(spark, tmp):
    from spoor.sources.rules import read_bundle

    for name, text in {"MANIFEST": "# files\na.mg1\n b.mg1 \ngone.mg1\n\nbad.mg1\n", "a.mg1": "x add 1\ny sub 2\n",
                       "b.mg1": "", "bad.mg1": "x multiply 1\n", "left.mg1": "z add 1\n"}.items():
        with open(f"{tmp}/{name}", "w") as f:
            f.write(text)
    found = read_bundle(spark, tmp)
    assert sorted((r.mix_id, r.ord, r.fd_id, r.op) for r in found.rules.collect()) == [
        ("a.mg1", 0, "x", "add"), ("a.mg1", 1, "y", "sub")]
    assert [r["name"] for r in found.missing.collect()] == ["gone.mg1"]
    assert [r.mix_id for r in found.rejects.collect()] == ["bad.mg1"]


def test_lookups_in_a_stored_index_leave_it_where_it_is(spark, tmp):
    from spoor.operators import lookup

    body = [(t, t // 3, 1, 1, 1, 0, 0) for t in range(500)]
    d = make(spark, {"a": body, "b": body[:200]})
    lookup.store_iat_index(d.rows, "iats_of_test", f"{tmp}/iats", buckets=4)
    probes = spark.createDataFrame([("a", 7), ("b", 66), ("b", 150), ("c", 1), ("a", 7)], "fd_id string, mb long")
    found = lookup.iats_in_index(spark, "iats_of_test", probes)
    assert sorted(map(tuple, found.collect())) == sorted(
        [("a", 7, t) for t in (21, 22, 23)] + [("b", 66, t) for t in (198, 199)])
    plan = found._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    scan = plan[plan.index("SortMergeJoin"):]
    left = scan[: scan.index("Exchange")] if "Exchange" in scan else scan
    assert "Scan parquet" in left and "Bucketed: true" in left
    spark.sql("DROP TABLE iats_of_test")
