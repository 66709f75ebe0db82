import os

import pytest
from helpers import make, rows_of

from spoor.__main__ import parser, run
from spoor.operators import curves
from spoor.plans import jobs
from spoor.sources import rules as r
from spoor.sources.curves import read_curve, write_curve
from spoor.sources.descriptors import read_descriptors, read_tables, write_descriptors
from spoor.sources.lines import read_lines

BODY = "10 5 2 400 2000 1000 3\n60 9 4 350 1800 0 0\n"
HEAD8 = "# 1000 5000000 86400 1200 300 900000 40 70000\n"


def put(folder, files):
    for name, text in files.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    return folder


def test_headers_of_every_width(spark, tmp):
    put(tmp, {
        "stdtime.eight": HEAD8 + BODY,
        "stdtime.six": "# 1000 5000000 86400 1200 300 900000\n" + BODY,
        "stdtime.four.key2": "# 1000 5000000 86400 1200\n" + BODY,
        "deep/stdtime.three.KEY7": "# 1000 5000000 86400\n" + BODY,
        "stdtime.b^f^X_1+2": "#1000 5000000 86400 7 x 5\n" + BODY,
        "other.eight": HEAD8 + BODY,
    })
    got = read_descriptors(spark, tmp)
    heads = {h.fd_id: tuple(h)[1:] for h in got.descriptors.headers.collect()}
    assert heads == {
        "eight": (1000, 5000000, 86400, 1200, 300, 900000, 40, 70000),
        "six": (1000, 5000000, 86400, 1200, 300, 900000, 0, 0),
        "four": (1000, 5000000, 86400, 1200, 0, 0, 0, 0),
        "three": (1000, 5000000, 86400, 0, 0, 0, 0, 0),
        "b^f^X_1+2": (1000, 5000000, 86400, 7, 0, 0, 0, 0),
    }
    assert got.descriptors.rows.count() == 10 and got.rejects.count() == 0
    keys = {f.fd_id: f.key_index for f in got.files.collect()}
    assert (keys["four"], keys["three"], keys["eight"]) == ("2", "7", "1")


def test_bad_files_are_set_aside(spark, tmp):
    put(tmp, {
        "stdtime.good": HEAD8 + BODY,
        "stdtime.empty": "",
        "stdtime.two": "# 1000 5000\n" + BODY,
        "stdtime.nohead": BODY,
        "stdtime.silent": "# 0 5 3\n" + BODY,
        "stdtime.short": HEAD8 + BODY + "70 1 2 3\n",
        "stdtime.blank": HEAD8 + "\n" + BODY,
        "stdtime.headonly": HEAD8,
        "a/stdtime.good": HEAD8 + BODY,
    })
    got = read_descriptors(spark, tmp)
    assert rows_of(got.rejects, "fd_id", "reason") == [
        ("blank", "bad line"), ("empty", "empty"), ("good", "superseded"),
        ("headonly", "no body"), ("nohead", "bad header"), ("short", "bad line"),
        ("silent", "no traffic"), ("two", "bad header")]
    assert rows_of(got.descriptors.rows) == [
        ("good", 10, 5, 2, 400, 2000, 1000, 3), ("good", 60, 9, 4, 350, 1800, 0, 0)]


def test_shards_in_one_file_add_up(spark, tmp):
    body = "10 5 2 1 2 3 4 ignored\n10 6 3 1 2 3 4\n10 7 4 1 2 3 4\n20 8 5 1 1 1 1\n"
    put(tmp, {"stdtime.s": "# 9 9 9 9\n# 8 8 8 8\n# 7 7 7 7\n" + body})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (old, "16b"):  # the second one reads the file in many small blocks
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = read_descriptors(spark, tmp).descriptors
            assert got.headers.first().total_requests == 9
            assert rows_of(got.rows) == [("s", 10, 7, 4, 3, 6, 9, 12), ("s", 20, 8, 5, 1, 1, 1, 1)]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.fixture
def uncoalesced(spark):
    """Keeps small range partitions apart, as large ones are."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


@pytest.mark.parametrize("form", ["text", "parquet"])
def test_round_trip(spark, tmp, form, uncoalesced):
    d = make(spark, {"a^b^c": [(t, t, t, 1, 2, 3, 4) for t in range(0, 3000, 7)],
                     "z": [(5, 1, 1, 1, 1, 1, 1)], "skip": [(5, 1, 1, 1, 1, 1, 1)],
                     "bad": [(5, 1, 1, 1, 1, 1, 1)]},
             {"skip": dict(total_requests=0), "bad": dict(total_served_bytes=-1)})
    rejects = write_descriptors(d, f"{tmp}/out", form=form)
    assert rows_of(rejects, "fd_id") == [("bad",)]
    if form == "text":
        parts = {x[:10] for _, _, names in os.walk(f"{tmp}/out") for x in names
                 if x.startswith("part-")}
        assert len(parts) > 1
        got = read_descriptors(spark, f"{tmp}/out", folders=True)
        assert got.rejects.count() == 0
        got = got.descriptors
    else:
        got = read_tables(spark, f"{tmp}/out")
    kept = d.named("a^b^c", "z")
    assert rows_of(got.rows) == rows_of(kept.rows)
    assert rows_of(got.headers, *got.headers.columns) == rows_of(
        kept.headers, *got.headers.columns)


def test_curve_round_trip(spark, tmp):
    d = make(spark, {"a": [(1, 5, 1, 1, 100, 0, 0), (2, 6, 2, 2, 100, 0, 0)]},
             {"a": dict(total_requests=400, total_served_bytes=1000)})
    none = make(spark, {"b": [(1, 5, 1, 1, 100, 0, 0)]})
    both = d.union(type(d)(none.headers, none.rows.filter("false")))
    curve = curves.space_curve(both)
    refused = write_curve(curve, both.headers, f"{tmp}/s", "mb", "text")
    assert rows_of(refused, "fd_id") == [("b",)]
    lines = [x.value for x in spark.read.text(f"{tmp}/s/name=stdspace.a").collect()]
    # one digit, half to even: 0.25 -> 0.2, 0.75 -> 0.8
    assert lines == ["# 400 1000 100 5 50 3 30", "5 1 0.2 100 10.0", "6 3 0.8 200 20.0"]
    got = rows_of(read_curve(spark, f"{tmp}/s"), "fd_id", "mb", "requests", "request_pct", "bytes")
    assert got == [("a", 5, 1, 0.2, 100), ("a", 6, 3, 0.8, 200)]
    write_curve(curves.count_curve(both), both.headers, f"{tmp}/c", "objcount", "text")
    assert sorted(os.path.basename(x) for x in os.listdir(f"{tmp}/c") if "=" in x) == [
        "name=stdcount.a", "name=stdcount.b"]
    write_curve(curve, both.headers, f"{tmp}/p")
    assert spark.read.parquet(f"{tmp}/p").count() == 2


def test_rule_lines(spark, tmp):
    put(tmp, {
        "g1.mg1.key2": "# note\na ADD 1\nb sub 0.5\nc add 20G\nd Add 3M 2/16 500 1 2 3\n"
                       "e concat 0.05K 4",
        "g2": "a add 1\nb mul 2\n",
        "g3": "a add 1x\n",
        "g4": "a add\n",
        "MANIFEST": "g1.mg1\ng2\n",
    })
    got = r.read_mix_rules(spark, tmp)
    cols = ["mix_id", "ord", "fd_id", "op", "scale", "scale_type", "num_shards", "total_shards",
            "max_mb", "min_mb", "max_count", "min_count"]
    assert rows_of(got.rules, *cols) == [
        ("g1.mg1", 0, "a", "add", 1.0, "absolute", 0, 0, 0, 0, 0, 0),
        ("g1.mg1", 1, "b", "sub", 0.5, "absolute", 0, 0, 0, 0, 0, 0),
        ("g1.mg1", 2, "c", "add", 20e9, "traffic", 0, 0, 0, 0, 0, 0),
        ("g1.mg1", 3, "d", "add", 3e6, "traffic", 2, 16, 500, 1, 2, 3),
        ("g1.mg1", 4, "e", "concat", 50.0, "traffic", 4, 0, 0, 0, 0, 0)]
    assert rows_of(got.rejects, "mix_id", "reason") == [
        ("g2", "bad action"), ("g3", "bad scale"), ("g4", "bad scale")]
    assert r.describe_rules(got.rules).count() == 5
    glob = r.read_mix_rules(spark, f"{tmp}/g1*")
    assert {x.mix_id for x in glob.rules.collect()} == {"g1.mg1"}
    put(tmp, {"one/my.config.key3": "a add 1\n"})
    single = f"{tmp}/one/my.config.key3"
    assert r.read_mix_rules(spark, single).rules.first().mix_id == "my"
    assert r.read_mix_rules(spark, single, "named").rules.first().mix_id == "named"
    r.write_mix_rules(got.rules, f"{tmp}/table")
    assert spark.read.parquet(f"{tmp}/table").count() == 5


def test_customer_map(spark):
    lines = spark.createDataFrame([
        ("  a b c v^f^X_2 more",), ("a b c v^f^X_1",), ("a b c",), ("a b c plain",), ("",),
        ("a b c v^f^X_1",), ("a b c w^Y",)], "value string")
    got = rows_of(r.rules_from_customer_map(lines), "mix_id", "ord", "fd_id", "op", "scale")
    assert got == [("v^f", 0, "v^f^X_1", "add", 1.0), ("v^f", 1, "v^f^X_1", "add", 1.0),
                   ("v^f", 2, "v^f^X_2", "add", 1.0), ("w", 0, "w^Y", "add", 1.0)]


def test_concat_rules(spark, tmp):
    put(tmp, {"c": "# x\na 1\nb 0.5\n", "bad": "a\n"})
    got = r.read_concat_rules(spark, f"{tmp}/c")
    assert rows_of(got.rules, "concat_id", "ord", "fd_id", "scale") == [
        ("mix", 0, "a", 1.0), ("mix", 1, "b", 0.5)]
    assert r.read_concat_rules(spark, f"{tmp}/bad").rejects.count() == 1


def test_lines_keep_their_order(spark, tmp):
    put(tmp, {"long": "".join(f"{i}\n" for i in range(5000))})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1kb")
    try:
        lines = read_lines(spark, tmp)
        assert lines.rdd.getNumPartitions() > 1
        assert [int(x.value) for x in lines.orderBy("pos").collect()] == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


# ---------------------------------------------------------------- jobs


@pytest.fixture
def inputs(tmp):
    return put(f"{tmp}/in", {
        "stdtime.a.key1": "# 100 1000 100 10 3 9 4 7\n" + BODY,
        "stdtime.b.key1": "# 200 4000 50 20 5 9 4 7\n20 1 1 5 50 0 0\n60 2 2 5 50 1 1\n",
        "stdtime.broken": "nothing\n",
    })


def test_mix_job(spark, tmp, inputs):
    put(f"{tmp}/rules", {"m1": "a add 1\nb add 1\ngone add 1\n", "m2": "a frob 1\n",
                         "m3": "b sub 1\n"})
    got = jobs.mix_job(spark, inputs, f"{tmp}/out", f"{tmp}/rules", form="text")
    assert rows_of(got.failures, "name", "reason") == [
        ("broken", "bad header"), ("m1/gone", "no such descriptor"), ("m2", "bad action"),
        ("m3", "invalid descriptor")]
    back = read_descriptors(spark, f"{tmp}/out", folders=True).descriptors
    assert rows_of(back.rows) == [
        ("m1", 10, 6, 3, 400, 2000, 1000, 3), ("m1", 20, 6, 3, 5, 50, 0, 0),
        ("m1", 60, 11, 6, 355, 1850, 1, 1)]
    assert tuple(back.headers.first()) == ("m1", 300, 5000, 100, 30, 8, 18, 8, 14)
    chain = jobs.mix_job(spark, inputs, f"{tmp}/chain", f"{tmp}/rules", in_rule_order=True)
    assert rows_of(read_tables(spark, f"{tmp}/chain").rows) == rows_of(back.rows)
    assert rows_of(chain.summary, "status", "n")[0][0] == "failed"


def test_mix_job_by_customer_map(spark, tmp, inputs):
    put(tmp, {"map": "1 2 3 n^a\n1 2 3 n^b\n", "in2/stdtime.n^a": HEAD8 + BODY})
    got = jobs.mix_job(spark, f"{tmp}/in2", f"{tmp}/out", customer_map=f"{tmp}/map",
                       thin_pct=150.0)
    assert rows_of(read_tables(spark, f"{tmp}/out").rows) == [("n", 60, 9, 4, 750, 3800, 1000, 3)]
    assert rows_of(got.failures, "name") == [("n/n^b",)]
    with pytest.raises(ValueError):
        jobs.mix_job(spark, f"{tmp}/in2", f"{tmp}/no")


def test_curve_and_unshard_jobs(spark, tmp, inputs):
    with pytest.raises(jobs.JobFailed):
        jobs.curve_job(spark, inputs, f"{tmp}/all", form="text")
    assert os.path.isdir(f"{tmp}/all/name=stdspace.a")  # written all the same
    got = jobs.curve_job(spark, f"{inputs}/stdtime.a.key1", f"{tmp}/one", "objcount")
    assert rows_of(got.summary, "status", "n") == [("ok", 1)]
    assert rows_of(spark.read.parquet(f"{tmp}/one"), "objcount", "requests", "bytes") == [
        (2, 400, 1990), (4, 750, 3790)]
    jobs.unshard_job(spark, f"{inputs}/stdtime.a.key1", f"{tmp}/big", 1.5)
    assert rows_of(read_tables(spark, f"{tmp}/big").rows) == [
        ("a", 10, 7, 3, 600, 3000, 1500, 4), ("a", 60, 13, 6, 525, 2700, 0, 0)]


def test_concat_job_and_command_line(spark, tmp, inputs):
    put(tmp, {"c": "a 1\nb 1\n"})
    for f in ("stdtime.a.key1", "stdtime.b.key1"):
        put(tmp, {f"good/{f}": open(f"{inputs}/{f}").read()})
    args = parser().parse_args(["concat", "--input", f"{tmp}/good", "--output", f"{tmp}/out",
                                "--rules", f"{tmp}/c", "--form", "parquet", "--name", "ab"])
    run(spark, args)
    # sizes 1, 2, 5, 9: IATs 20, 60, (10+60)/2, (60+60)/2; caches 2, 4, 5+2, 9+2
    assert rows_of(read_tables(spark, f"{tmp}/out").rows) == [
        ("ab", 20, 2, 0, 5, 50, 0, 0), ("ab", 35, 7, 0, 400, 2000, 1000, 3),
        ("ab", 60, 11, 0, 355, 1850, 1, 1)]
    args = parser().parse_args(["t2s", "--input", f"{tmp}/good", "--output", f"{tmp}/s",
                                "--form", "parquet", "--icp"])
    run(spark, args)
    assert spark.read.parquet(f"{tmp}/s").filter("fd_id = 'a'").agg(
        {"requests": "max"}).first()[0] == 753
    for job in (["unshard", "--factor", "2"], ["mix", "--rules", f"{tmp}/r"]):
        put(tmp, {"r/m": "a add 1\n"})
        run(spark, parser().parse_args(
            [*job, "--input", f"{tmp}/good", "--output", f"{tmp}/{job[0]}"]))
        assert any(x.startswith("name=stdtime.") for x in os.listdir(f"{tmp}/{job[0]}"))
