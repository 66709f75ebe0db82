import random

import pytest
from helpers import floor_row, make, random_body, rows_of

from spoor.operators import quickadd as q
from spoor.operators.concat import concat
from spoor.operators.thin import thin

# ---------------------------------------------------------------- quick add


def rising(rng, n):
    """A body whose footprint rises at every row."""
    mb, out = 0, []
    for t in sorted(rng.sample(range(1, 500), n)):
        mb += rng.randint(1, 9)
        out.append((t, mb, mb, *[rng.randint(1, 9) for _ in range(4)]))
    return out


def cumulative(body):
    total, out = 0, []
    for r in body:
        total += r[4]
        out.append((r[0], r[1], total))
    return out


def joint(bodies, served, cache):
    """Walks over every IAT in the search range; the last one that fits counts."""
    cums = [cumulative(b) for b in bodies]
    right = min(next((r[0] for r in b if r[1] > cache), b[-1][0]) for b in bodies)
    left = min(max([r[0] for r in b if r[1] <= cache // 2], default=b[0][0]) for b in bodies)
    at = left
    for t in range(left, right):
        if sum(floor_row(b, t)[1] for b in cums) <= cache:
            at = t
    return sum(floor_row(b, at)[2] for b in cums), sum(served), at


@pytest.mark.parametrize("cache", [10, 60, 110])
def test_quick_add(spark, cache):
    rng = random.Random(cache)
    bodies = {f"c{i}": rising(rng, 25) for i in range(5)}
    d = make(spark, bodies)
    groups = {"p": ["c0", "c1"], "q": ["c2", "c3", "c4"], "one": ["c3"]}
    table = spark.createDataFrame([(g, n) for g, ns in groups.items() for n in ns],
                                  "mix_id string, fd_id string")
    served = {r.fd_id: r.total_served_bytes for r in d.headers.collect()}
    want = []
    for g, ns in groups.items():
        if len(ns) > 1:
            want.append((g, *joint([bodies[n] for n in ns], [served[n] for n in ns], cache)))
        else:
            cum = cumulative(bodies[ns[0]])
            row = next((r for r in cum if r[1] > cache), cum[-1])
            want.append((g, row[2], served[ns[0]], row[0]))
    got = rows_of(q.quick_add(table, d, cache), "mix_id", "hit_bytes", "served_bytes", "iat")
    assert got == sorted(want)
    alone = rows_of(q.quick_lookup(d.named("c3"), cache), "hit_bytes", "iat")
    assert alone == [want[2][1:2] + want[2][3:]]


def test_an_empty_side_leaves_the_other(spark):
    rng = random.Random(1)
    d = make(spark, {"a": rising(rng, 9), "b": rising(rng, 9)}, {"b": dict(total_requests=0)})
    table = spark.createDataFrame([("m", "a"), ("m", "b")], "mix_id string, fd_id string")
    got = rows_of(q.quick_add(table, d, 20), "hit_bytes", "served_bytes", "iat")
    assert got == rows_of(q.quick_lookup(d.named("a"), 20), "hit_bytes", "served_bytes", "iat")


def test_marker_has_to_exist(spark):
    d = make(spark, {"a": [(t, 10 * t, 1, 1, t, 0, 0) for t in range(1, 6)]})
    with pytest.raises(ValueError):
        q.quick_lookup(d, 20, [10, 30])
    # three markers below the first footprint take the first three rows
    assert [q.quick_lookup(d, c, [1, 2, 3]).first().iat for c in (1, 2, 3)] == [1, 2, 3]
    table = spark.createDataFrame([("m", "a")], "mix_id string, fd_id string")
    assert q.quick_add(table, d, 3, [1, 2, 3]).first().hit_bytes == 6


# ---------------------------------------------------------------- concat


def side_by_side(bodies, weights, cmax):
    """One footprint after the other, every member asked."""
    sizes = sorted({r[1] for b in bodies for r in b if r[1] <= cmax})
    tops = [max(r[1] for r in b) for b in bodies]
    mean_of = [None] * len(bodies)
    out = {}
    for size in sizes:
        exact, num, den, traffic = 0, 0.0, 0, [0] * 4
        for i, b in enumerate(bodies):
            hits = [r for r in b if r[1] == size]
            if hits:
                times = sum(r[0] for r in hits)
                num += weights[i] * times / len(hits)
                den += weights[i]
                mean_of[i] = times // len(hits)
                exact += 1
                for r in hits:
                    traffic = [x + y for x, y in zip(traffic, r[3:])]
            elif mean_of[i] is not None:
                num += mean_of[i] * weights[i]
                den += weights[i]
        mb = sum(min(size, top) for top in tops)
        t = int(num / den + 1e-9)
        old = out.get(t, (0, 0, 0, 0, 0, 0))
        out[t] = (mb, 0, *[x + y for x, y in zip(old[2:], traffic)])
    return sorted((t, *v) for t, v in out.items())


@pytest.mark.parametrize("weighted", [False, True])
@pytest.mark.parametrize("cmax", [60, 10**6])
def test_concat(spark, weighted, cmax):
    rng = random.Random(cmax + weighted)
    bodies = {f"c{i}": random_body(rng, 20) for i in range(4)}
    d = make(spark, bodies)
    sets = {"x": ["c0", "c1", "c2"], "y": ["c3", "c1"], "z": ["c0"]}
    table = spark.createDataFrame(
        [(s, i, n, 1.0) for s, ns in sets.items() for i, n in enumerate(ns)],
        "concat_id string, ord int, fd_id string, scale double")
    served = {r.fd_id: r.total_served_bytes for r in d.headers.collect()}
    want = []
    for s, ns in sets.items():
        weights = [served[n] if weighted else 1 for n in ns]
        want += [(s, *r) for r in side_by_side([bodies[n] for n in ns], weights, cmax)]
    got = concat(table, d, weigh_by_traffic=weighted, cmax=cmax)
    assert rows_of(got.rows) == sorted(want)


def test_concat_scale_ghosts_and_missing(spark):
    d = make(spark, {"a": [(10, 5, 1, 4, 40, 2, 1), (11, 6, 2, 6, 60, 4, 3)]})
    table = spark.createDataFrame(
        [("x", 0, "a", 0.5), ("gone", 0, "a", 1.0), ("gone", 1, "b", 1.0), ("zero", 0, "a", 0.0)],
        "concat_id string, ord int, fd_id string, scale double")
    got = concat(table, d, min_ghost=2)
    # both rows move to IAT 5 and add up; the last footprint counts
    assert rows_of(got.rows) == [("x", 5, 6, 0, 5, 50, 3, 1)]
    h = got.headers.collect()
    assert [r.fd_id for r in h] == ["x"] and h[0].unique_objects == 2


# ---------------------------------------------------------------- thinning


def thinned(body, pct):
    """Definition of thinning, row by row."""
    def moved(new, old):
        if old == 0:
            return new != 0
        return abs((new - old) * 100.0 / old) >= pct

    out, last, carry = [], None, [0] * 4
    for r in body:
        keep = 100 >= pct if last is None else moved(r[0], last[0]) or moved(r[1], last[1])
        carry = [x + y for x, y in zip(carry, r[3:])]
        if keep:
            out.append((*r[:3], *carry))
            last, carry = r, [0] * 4
    if carry[0] > 0 and body[-1][0] != (last[0] if last else 0):
        out.append((*body[-1][:3], *carry))
    return out


@pytest.mark.parametrize("pct", [0, 3, 10, 60, 100, 150])
def test_thin(spark, pct):
    rng = random.Random(pct)
    bodies = {f"c{i}": random_body(rng, rng.randint(1, 60), silent=True) for i in range(8)}
    bodies["zero"] = [(0, 0, 0, 5, 5, 5, 5)]
    bodies["start"] = [(0, 0, 0, 5, 5, 5, 5), (1, 0, 0, 1, 1, 1, 1), (2, 0, 0, 0, 1, 0, 0)]
    d = make(spark, bodies)
    want = sorted((n, *r) for n, b in bodies.items() for r in thinned(b, pct))
    assert rows_of(thin(d.rows, pct)) == want


def test_thin_across_batches(spark):
    rng = random.Random(2)
    body = random_body(rng, 3000, top=50_000)
    d = make(spark, {"a": body, "b": body[:1500]})
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = rows_of(thin(d.rows, 2.0))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert got == sorted([("a", *r) for r in thinned(body, 2.0)]
                         + [("b", *r) for r in thinned(body[:1500], 2.0)])
    assert sum(r[4] for r in got if r[0] == "a") == sum(r[3] for r in body)


def test_thin_where_the_footprint_falls(spark):
    rng = random.Random(21)
    bodies = {}
    for n in "abc":
        body = random_body(rng, 80, top=900)
        bodies[n] = body if n == "b" else [(t, rng.randint(0, 40), *r) for t, _, *r in body]
    d = make(spark, bodies)
    want = sorted((n, *r) for n, b in bodies.items() for r in thinned(b, 12.0))
    assert rows_of(thin(d.rows, 12.0)) == want
