import random

import pytest
from helpers import make, random_body, rows_of
from pyspark.sql import functions as F

from spoor.model import Descriptors
from spoor.operators import transform as t
from spoor.operators.scan import Running, scan, segment_of


def test_scale_collision_last_and_merge(spark):
    d = make(spark, {"a": [(10, 5, 1, 4, 40, 2, 1), (11, 6, 2, 6, 60, 4, 3)]})
    assert rows_of(t.scale(d, 2.0).rows) == [("a", 5, 6, 2, 12, 120, 8, 6)]
    assert rows_of(t.scale(d, 2.0, "merge").rows) == [("a", 5, 6, 2, 20, 200, 12, 8)]


def test_scale_header_keeps_duration_and_uniques(spark):
    d = make(spark, {"a": [(10, 5, 1, 4, 40, 2, 1)]}, {"a": dict(total_requests=7, total_mib=9)})
    h = t.scale(d, 0.5).headers.first()
    assert (h.total_requests, h.total_mib, h.peak_requests_300s) == (3, 4, 1)
    assert (h.duration, h.unique_objects, h.unique_bytes) == (100, 5, 50)


def test_truncation_is_toward_zero(spark):
    d = make(spark, {"a": [(10, 5, 1, 3, 3, 3, 3)]})
    assert rows_of(t.scale(d, 0.5).rows) == [("a", 20, 5, 1, 1, 1, 1, 1)]
    assert rows_of(t.scale(d, -0.5).rows) == [("a", 20, 5, 1, -1, -1, -1, -1)]
    with pytest.raises(ValueError):
        t.scale(d, 0)


def test_scale_to_traffic_uses_integer_rate(spark):
    d = make(spark, {"a": [(10, 5, 1, 30, 900, 0, 0)]},
             {"a": dict(total_served_bytes=1000, duration=3),})
    # 8000 div 3 = 2666 bits/s
    assert rows_of(t.scale_to_traffic(d, 1333.0).rows) == [("a", 20, 5, 1, 15, 450, 0, 0)]
    still = make(spark, {"a": [(10, 5, 1, 30, 900, 0, 0)]}, {"a": dict(duration=0)})
    assert rows_of(t.scale_to_traffic(still, 5.0).rows) == []


def test_shard_unshard_fraction(spark):
    d = make(spark, {"a": [(10, 100, 10, 31, 33, 7, 8)]})
    assert rows_of(t.shard(d, 3).rows) == [("a", 10, 33, 3, 10, 11, 2, 2)]
    assert rows_of(t.unshard(d, 2.5).rows) == [("a", 10, 250, 25, 77, 82, 17, 20)]
    assert rows_of(t.shard_fraction(d, 2, 3).rows) == [("a", 10, 66, 6, 20, 22, 4, 4)]
    assert rows_of(t.shard_fraction(d, 3, 3).rows) == rows_of(d.rows)
    assert rows_of(t.shard_fraction(d, 0, 3).rows) == rows_of(t.shard(d, 3).rows)
    assert rows_of(t.shard(d, 0).rows) == rows_of(d.rows)


def test_shard_then_unshard_never_exceeds(spark):
    rng = random.Random(1)
    d = make(spark, {f"c{i}": random_body(rng, 20) for i in range(3)})
    back = t.unshard(t.shard(d, 7), 7)
    for a, b in zip(rows_of(back.rows), rows_of(d.rows)):
        assert a[:2] == b[:2] and all(x <= y for x, y in zip(a[2:], b[2:]))


def test_stretch_and_split(spark):
    d = make(spark, {"a": [(10, 100, 10, 31, 33, 7, 8)]})
    s = t.stretch_duration(d, 250)
    assert rows_of(s.rows) == [("a", 10, 100, 10, 77, 82, 7, 8)]
    assert s.headers.first().duration == 250
    v = t.split_virtual(d, 4)
    assert rows_of(v.rows) == [("a", 40, 25, 2, 7, 8, 1, 2)]
    assert v.headers.first().unique_objects == 5


def test_coalesce_adds_traffic_and_keeps_the_last_footprint(spark):
    lines = spark.createDataFrame(
        [("a", 5, 1, 1, 2, 3, 4, 5, 0), ("a", 5, 9, 8, 2, 3, 4, 5, 1)],
        "fd_id string, delta_t long, mb long, objcount long, requests long, bytes long,"
        "tr_bytes long, tr_requests long, line_no long",
    )
    assert rows_of(t.coalesce_rows(lines)) == [("a", 5, 9, 8, 4, 6, 8, 10)]


def test_single_precision(spark):
    d = make(spark, {"a": [(10, 123456789, 1, 123456789, 16777217, 0, 0)]})
    got = t.float32_traffic(d).rows.first()
    assert (got.mb, got.requests, got.bytes) == (123456789, 123456792, 16777216)
    assert t.unshard(d, 1.0, True).rows.first().mb == 123456792
    assert t.unshard(d, 1.0).rows.first().mb == 123456789


def test_validity(spark):
    d = make(spark, {"a": [(1, 1, 1, 1, 1, 1, 1)], "b": [(1, 1, 1, 1, 1, 1, 1)]},
             {"b": dict(total_requests=0)})
    bodyless = make(spark, {"c": [(1, 1, 1, 1, 1, 1, 1)]})
    both = d.union(Descriptors(bodyless.headers, bodyless.rows.filter("false")))
    got = {r.fd_id: (r.is_empty, r.is_valid) for r in t.validity(both).collect()}
    assert got == {"a": (False, True), "b": (True, False), "c": (False, False)}


def test_segments_never_decrease(spark):
    values = sorted({s * (2**e + d) for e in range(0, 62) for d in (-1, 0, 1) for s in (1, -1)})
    got = spark.createDataFrame([(v,) for v in values], "x long").select(
        "x", F.expr(segment_of("x")).alias("s")).orderBy("x").collect()
    numbers = [r.s for r in got]
    assert numbers == sorted(numbers) and None not in numbers


def test_scan_equals_a_plain_loop(spark):
    rng = random.Random(7)
    data = []
    for key in "xyz":
        for at in sorted(rng.sample(range(-50, 100_000), 200)):
            data.append((key, at, rng.randint(-5, 9), rng.choice([None, 1, 2, 3])))
    df = spark.createDataFrame(data, "k string, at long, v long, o long")
    got = scan(df, ["k"], ["at"], {
        "sum": Running("sum", "v"), "max": Running("max", "v"),
        "last": Running("last", "o"), "next": Running("next", "o"),
        "lag": Running("lag", "v"), "lead": Running("lead", "v"),
        "first": Running("first", "o"), "total": Running("total", "v"),
        "least": Running("least", "v"), "most": Running("most", "v"),
    }).orderBy("k", "at").collect()
    want = []
    for key in "xyz":
        part = [r for r in data if r[0] == key]
        for i, r in enumerate(part):
            upto, onward = part[: i + 1], part[i:]
            seen = [x[3] for x in upto if x[3] is not None]
            ahead = [x[3] for x in onward if x[3] is not None]
            some = [x[3] for x in part if x[3] is not None]
            want.append((
                *r, sum(x[2] for x in upto), max(x[2] for x in upto),
                seen[-1] if seen else None, ahead[0] if ahead else None,
                part[i - 1][2] if i else None, part[i + 1][2] if i + 1 < len(part) else None,
                some[0], sum(x[2] for x in part),
                min(x[2] for x in part), max(x[2] for x in part),
            ))
    assert [tuple(r) for r in got] == want
