import random

import pytest
from helpers import add_bodies, make, random_body, rows_of, rules

from spoor.operators import mix as m
from spoor.operators import transform as t


def members_of(*names, mix="m", **kw):
    return [dict(mix_id=mix, fd_id=n, **kw) for n in names]


def test_backfill_before_the_first_row(spark):
    d = make(spark, {"a": [(10, 3, 1, 1, 1, 0, 0)], "b": [(50, 7, 2, 1, 1, 0, 0)]})
    got = rows_of(m.mix(rules(spark, *members_of("a", "b")), d).rows)
    assert got == [("m", 10, 10, 3, 1, 1, 0, 0), ("m", 50, 10, 3, 1, 1, 0, 0)]


def test_one_member_is_the_prepared_descriptor(spark):
    d = make(spark, {"a": random_body(random.Random(3), 30, silent=True)})
    got = m.mix(rules(spark, *members_of("a", scale=2.0)), d)
    want = t.scale(d, 2.0)
    assert [r[1:] for r in rows_of(got.rows)] == [r[1:] for r in rows_of(want.rows)]
    assert tuple(got.headers.first())[1:] == tuple(want.headers.first())[1:]


@pytest.mark.parametrize("seed", range(4))
def test_sweep_equals_two_way_additions(spark, seed):
    rng = random.Random(seed)
    bodies = {f"c{i}": random_body(rng, rng.randint(1, 25)) for i in range(6)}
    d = make(spark, bodies)
    groups = {f"m{k}": rng.sample(sorted(bodies), rng.randint(2, 6)) for k in range(5)}
    table = rules(spark, *[r for g, names in groups.items() for r in members_of(*names, mix=g)])
    want = []
    for g, names in groups.items():
        total = bodies[names[0]]
        for n in names[1:]:
            total = add_bodies(total, bodies[n])
        want += [(g, *r) for r in total]
    assert rows_of(m.mix(table, d).rows) == sorted(want)


def test_rule_order_chain_drops_silent_rows_at_once(spark):
    rng = random.Random(11)
    bodies = {f"c{i}": random_body(rng, 12, silent=True, top=40) for i in range(4)}
    d = make(spark, bodies)
    table = rules(spark, *members_of(*bodies), *members_of("c2", "c0", mix="n"))
    want = bodies["c0"]
    for n in ("c1", "c2", "c3"):
        want = add_bodies(want, bodies[n])
    other = add_bodies(bodies["c2"], bodies["c0"])
    got = m.mix_in_rule_order(table, d)
    assert rows_of(got.rows) == sorted([("m", *r) for r in want] + [("n", *r) for r in other])
    assert rows_of(got.headers, "fd_id", "total_requests", "unique_objects") == rows_of(
        m.mix(table, d).headers, "fd_id", "total_requests", "unique_objects")


def test_subtract_cancels_traffic_and_adds_footprint(spark):
    d = make(spark, {"a": [(10, 3, 1, 5, 50, 0, 0)], "b": [(10, 3, 1, 2, 20, 0, 0)]})
    same = rules(spark, *members_of("a"), dict(mix_id="m", fd_id="a", op="sub"))
    assert rows_of(m.mix(same, d).rows) == []
    less = rules(spark, *members_of("a"), dict(mix_id="m", fd_id="b", op="sub"))
    assert rows_of(m.mix(less, d).rows) == [("m", 10, 6, 2, 3, 30, 0, 0)]


def test_collisions_inside_a_mix(spark):
    bodies = {"a": [(1, 1, 1, 2, 2, 2, 2), (2, 4, 2, 4, 4, 4, 4), (3, 9, 3, 6, 6, 6, 6)],
              "b": [(1, 10, 10, 1, 1, 1, 1)]}
    d = make(spark, bodies)
    table = rules(spark, *members_of("a", scale=2.0), *members_of("b"))
    a = [r[1:] for r in rows_of(t.scale(d.named("a"), 2.0).rows)]
    want = [("m", *r) for r in add_bodies(a, bodies["b"])]
    assert rows_of(m.mix(table, d).rows) == want
    merged = [r[1:] for r in rows_of(t.scale(d.named("a"), 2.0, "merge").rows)]
    want = [("m", *r) for r in add_bodies(merged, bodies["b"])]
    assert rows_of(m.mix(table, d, collision="merge").rows) == want


def test_prepared_members_follow_shards_and_scale(spark):
    d = make(spark, {"a": [(12, 100, 10, 31, 33, 7, 8)]})
    table = rules(spark, dict(mix_id="m", fd_id="a", num_shards=2, total_shards=3, scale=3.0))
    got = rows_of(m.prepared_rows(table, d), "delta_t", "mb", "objcount", "requests")
    assert got == [(4, 66, 6, 60)]
    assert rows_of(m.prepared_rows(table, d, "merge"), "delta_t", "mb") == [(4, 66)]


def test_missing_empty_and_unusable_members(spark):
    d = make(spark, {"a": [(10, 3, 1, 5, 50, 0, 0)], "b": [(20, 3, 1, 2, 20, 0, 0)]},
             {"b": dict(total_requests=2)})
    table = rules(spark, *members_of("a", "gone"),
                  dict(mix_id="m", fd_id="b", scale=0.1),
                  dict(mix_id="m", fd_id="a", scale=0.0))
    assert rows_of(m.missing_members(table, d.headers), "mix_id", "fd_id") == [("m", "gone")]
    status = {(r.fd_id, r.ord): r.status for r in m.members(table, d.headers).collect()}
    assert status == {("a", 0): "ok", ("b", 2): "empty", ("a", 3): "zero_scale"}
    assert rows_of(m.mix(table, d).rows) == [("m", 10, 3, 1, 5, 50, 0, 0)]


def test_concat_lines_only_open_a_mix(spark):
    d = make(spark, {"a": [(10, 3, 1, 5, 50, 0, 0)], "b": [(20, 4, 1, 2, 20, 0, 0)]})
    later = rules(spark, *members_of("a"), dict(mix_id="m", fd_id="b", op="concat"))
    assert rows_of(m.mix(later, d).rows) == [("m", 10, 3, 1, 5, 50, 0, 0)]
    first = rules(spark, dict(mix_id="m", fd_id="b", op="concat"), *members_of("a"))
    assert len(rows_of(m.mix(first, d).rows)) == 2


def test_equal_durations_share(spark):
    d = make(spark, {"a": [(10, 3, 1, 5, 50, 0, 0)], "b": [(10, 4, 1, 8, 20, 0, 0)]},
             {"a": dict(duration=50), "b": dict(duration=100)})
    got = rows_of(m.mix(rules(spark, *members_of("a", "b")), d, equalize_durations=True).rows)
    assert got == [("m", 10, 7, 2, 10, 45, 0, 0)]  # 5*0.5+8 -> 10


def test_levels(spark):
    bodies = {n: random_body(random.Random(i), 10) for i, n in enumerate("abcd")}
    d = make(spark, bodies)
    low = rules(spark, *members_of("a", "b", mix="x"), *members_of("c", "d", mix="y"))
    top = rules(spark, *members_of("x", "y", mix="flat"))
    want = add_bodies(add_bodies(bodies["a"], bodies["b"]), add_bodies(bodies["c"], bodies["d"]))
    got = m.mix_in_levels([low, top], d)
    assert rows_of(got.rows) == [("flat", *r) for r in want]


def test_add_two(spark):
    bodies = {n: random_body(random.Random(i), 10) for i, n in enumerate("ab")}
    d = make(spark, bodies)
    got = m.add(d.named("a"), d.named("b"), "sum")
    assert rows_of(got.rows) == [("sum", *r) for r in add_bodies(bodies["a"], bodies["b"])]
