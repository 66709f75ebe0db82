import random

import pytest
from helpers import floor_row, make, random_body, rows_of
from pyspark.sql import functions as F

from spoor.operators import curves as c
from spoor.operators import lookup as k
from spoor.operators import summary as s


@pytest.fixture(scope="module")
def bodies():
    rng = random.Random(5)
    return {f"c{i}": random_body(rng, 40) for i in range(3)}


@pytest.fixture(scope="module")
def d(spark, bodies):
    return make(spark, bodies, {"c0": dict(total_mib=7)})


def probes(spark, names, values, column):
    return spark.createDataFrame([(n, v) for n in names for v in values],
                                 f"fd_id string, {column} long")


TIMES = [-5, 0, 1, 17, 100, 250, 399, 10_000]


def test_asof_and_matching(spark, bodies, d):
    p = probes(spark, bodies, TIMES, "t")
    want = sorted((n, t, *floor_row(b, t)) for n, b in bodies.items() for t in TIMES)
    cols = ["fd_id", "t", "delta_t", "mb", "objcount", "requests", "bytes", "tr_bytes",
            "tr_requests"]
    assert rows_of(k.asof(d.rows, p), *cols) == want
    zeroed = sorted((*r[:5], *(r[5:] if r[1] == r[2] else (0,) * 4)) for r in want)
    assert rows_of(k.matching(d.rows, p), *cols) == zeroed
    assert rows_of(k.stack_distance(d.rows, p), "fd_id", "t", "mb") == [
        (r[0], r[1], r[3]) for r in want]


def test_a_value_asked_often_is_answered_as_often(spark, bodies, d):
    p = spark.createDataFrame([("c0", 17, i) for i in range(500)] + [("c1", 3, -1)],
                              "fd_id string, t int, who long")
    got = k.asof(d.rows, p)
    assert got.count() == 501
    assert sorted(r.who for r in got.collect())[:2] == [-1, 0]
    assert {r.delta_t for r in got.filter("fd_id = 'c0'").collect()} == {
        floor_row(bodies["c0"], 17)[0]}


def walk(body, t, max_mb, min_mb, max_n, min_n, unset_is_zero):
    """Definition of the lookup within a quota, row by row."""
    i = max([j for j, r in enumerate(body) if r[0] <= t], default=0)
    if max_mb or max_n:
        cap_mb = max_mb or (0 if unset_is_zero else 10**9)
        cap_n = max_n or (0 if unset_is_zero else 10**9)
        while i > 0 and not (body[i][1] <= cap_mb and body[i][2] <= cap_n):
            i -= 1
    if min_mb or min_n:
        while i < len(body) - 1 and not (body[i][1] >= min_mb and body[i][2] >= min_n):
            i += 1
    return body[i]


@pytest.mark.parametrize("unset", [False, True])
@pytest.mark.parametrize("limits", [(40, 0, 0, 0), (0, 0, 0, 20), (60, 30, 30, 10),
                                    (0, 500, 0, 0), (1, 0, 1, 0)])
def test_asof_within_quota(spark, bodies, d, limits, unset):
    max_mb, min_mb, max_n, min_n = limits
    q = c.Quota(max_mb, min_mb, max_n, min_n)
    got = k.asof_within(d.rows, probes(spark, bodies, TIMES, "t"), q, unset)
    want = sorted((n, t, *walk(b, t, *limits, unset)[:3]) for n, b in bodies.items() for t in TIMES)
    assert rows_of(got, "fd_id", "t", "delta_t", "mb", "objcount") == want


def test_matching_within(spark, bodies, d):
    got = k.matching_within(d.rows, probes(spark, bodies, [10_000], "t"), c.Quota(max_mb=50))
    assert all(r.requests == 0 for r in got.collect())


def test_iat_for_mb_and_exact(spark, bodies, d):
    sizes = [-1, 0, 5, 33, 60, 10_000]
    got = k.iat_for_mb(d.rows, probes(spark, bodies, sizes, "target_mb"))
    want = sorted((n, v, max([r[0] for r in b if r[1] <= v], default=b[0][0]))
                  for n, b in bodies.items() for v in sizes)
    assert rows_of(got, "fd_id", "target_mb", "delta_t") == want
    got = k.iats_with_mb(d.rows, probes(spark, bodies, [33, 34, 35], "mb"))
    want = sorted((n, r[1], r[0]) for n, b in bodies.items() for r in b if r[1] in (33, 34, 35))
    assert rows_of(got, "fd_id", "mb", "delta_t") == want
    want = sorted({(n, r[1]) for n, b in bodies.items() for r in b})
    assert rows_of(k.stack_distances(d.rows), "fd_id", "mb") == want


@pytest.mark.parametrize("sizes", [[20], [3, 4, 5, 6, 50], [10, 10**6], list(range(0, 120, 2))])
def test_markers_take_a_row_each(spark, bodies, d, sizes):
    want = []
    for n, b in bodies.items():
        at = -1
        for size in sizes:
            later = [i for i in range(at + 1, len(b)) if b[i][1] > size]
            if later:
                at = later[0]
                want.append((n, size, b[at][0]))
            else:
                at = len(b)
                want.append((n, size, b[-1][0]))
    assert rows_of(k.markers(d.rows, sizes), "fd_id", "marker_mb", "delta_t") == sorted(want)


def curve_of(body, axis, icp=False, keep=lambda r: True, mib=0):
    points, requests, size = {}, 0, 0
    for r in sorted(body, key=lambda r: r[axis]):
        if keep(r):
            requests += r[3] + (r[6] if icp else 0)
            size += r[4] + (r[5] if icp else 0)
            points[r[axis]] = (requests, size - mib)
    return points


def test_curves(spark, bodies, d):
    for axis, column, make_curve in ((1, "mb", c.space_curve), (2, "objcount", c.count_curve)):
        for icp in (False, True):
            want = sorted((n, x, *v) for n, b in bodies.items()
                          for x, v in curve_of(b, axis, icp, mib=7 if n == "c0" else 0).items())
            assert rows_of(make_curve(d, icp), "fd_id", column, "requests", "bytes") == want
    got = c.space_curve(d, quota=c.Quota(max_mb=60, min_count=8))
    want = sorted((n, x, *v) for n, b in bodies.items() for x, v in curve_of(
        b, 1, keep=lambda r: r[1] <= 60 and r[2] >= 8, mib=7 if n == "c0" else 0).items())
    assert rows_of(got, "fd_id", "mb", "requests", "bytes") == want


def test_curve_lookups(spark, bodies, d):
    curve = c.space_curve(d)
    total = {r.fd_id: r.total_served_bytes for r in d.headers.collect()}
    points = {n: sorted(curve_of(b, 1, mib=7 if n == "c0" else 0).items())
              for n, b in bodies.items()}
    sizes = [-1, 0, 17, 60, 10_000]

    def at(n, v):
        below = [p for p in points[n] if p[0] <= v]
        return below[-1] if below else points[n][0]

    p = probes(spark, bodies, sizes, "cache_mb")
    want = sorted((n, v, *at(n, v)[1]) for n in bodies for v in sizes)
    assert rows_of(k.curve_lookup(curve, p), "fd_id", "cache_mb", "requests", "bytes") == want
    got = rows_of(k.hit_rate_at(curve, d.headers, p), "fd_id", "cache_mb", "byte_hit_pct")
    assert got == sorted((n, v, at(n, v)[1][1] * 100.0 / total[n]) for n in bodies for v in sizes)
    got = rows_of(c.max_hit_rate(curve, d.headers), "fd_id", "max_hit_rate")
    assert got == sorted((n, points[n][-1][1][1] * 100.0 / total[n]) for n in bodies)

    rates = [0.0, 1.5, 7.25, 10.0, 99.0]
    asked = spark.createDataFrame([(n, r) for n in bodies for r in rates],
                                  "fd_id string, hit_pct double")
    want = []
    for n in bodies:
        for r in rates:
            hit = int(total[n] * r / 100.0)
            want.append((n, r, max([x for x, v in points[n] if v[1] <= hit],
                                   default=points[n][0][0])))
    got = rows_of(k.size_for_hit_rate(curve, d.headers, asked), "fd_id", "hit_pct", "mb")
    assert got == sorted(want)

    count = c.count_curve(d)
    found = k.count_lookup(count, probes(spark, bodies, [10**6], "cache_objects"))
    tops = {n: sorted(curve_of(b, 2, mib=7 if n == "c0" else 0).items())[-1]
            for n, b in bodies.items()}
    assert rows_of(found, "fd_id", "objcount", "requests") == sorted(
        (n, x, v[0]) for n, (x, v) in tops.items())


def test_cumulative_bytes(spark, bodies, d):
    got = rows_of(k.with_cum_bytes(d.rows), "fd_id", "delta_t", "cum_bytes")
    want = [(n, r[0], sum(x[4] for x in b if x[0] <= r[0])) for n, b in bodies.items() for r in b]
    assert got == sorted(want)


def test_summaries(spark, d, bodies):
    heads = d.headers.filter("fd_id = 'c0'").withColumns(
        {"total_requests": F.lit(1050).cast("long"),
         "total_served_bytes": F.lit(10**12).cast("long"),
         "peak_requests_300s": F.lit(700).cast("long"),
         "peak_bytes_300s": F.lit(3 * 10**9 + 1).cast("long")})
    r = s.traffic_summary(heads).first()
    assert (r.avg_hits_per_s, r.peak_hits_per_s, r.avg_gbps, r.peak_gbps) == (10, 2, 80, 0.08)
    still = s.traffic_summary(heads.withColumn("duration", F.lit(0).cast("long"))).first()
    assert still.avg_hits_per_s is None and still.avg_gbps is None
    assert rows_of(s.extents(d.rows), "fd_id", "max_delta_t", "max_mb", "max_objcount") == sorted(
        (n, b[-1][0], b[-1][1], b[-1][2]) for n, b in bodies.items())
    volumes = [r.total_served_bytes for r in s.order_descriptors(d.headers, True).collect()]
    assert volumes == sorted(volumes, reverse=True)
    sizes = [r.max_mb for r in s.order_curves(c.space_curve(d)).collect()]
    assert sizes == sorted(sizes)
    assert rows_of(s.preview(d.rows, ["fd_id", "delta_t"], 5)) == rows_of(d.rows)[:5]
    done = spark.createDataFrame([("a",), ("b",)], "name string")
    got = rows_of(s.run_summary(done, done.limit(1)), "status", "n")
    assert got == [("failed", 1), ("ok", 2)]
