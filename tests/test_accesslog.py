import random

from helpers import rows_of
from pyspark.sql import functions as F

from spoor.model import LINK_COLS, ROW_COLS
from spoor.operators import accesslog as a
from spoor.operators.transform import linked
from spoor.streaming import accesslog as live


def random_log(rng, n):
    """One object owns a third of the lines."""
    out = []
    for i in range(n):
        obj = "hot" if rng.random() < 0.34 else f"o{rng.randint(0, n // 5)}"
        sec = rng.randint(0, 5000)
        out.append((rng.choice("ab"), obj, sec, sec * 1000 + rng.randint(0, 999), i,
                    rng.randint(1, 50)))
    return out


def by_hand(log):
    history = {}
    for fd, obj, sec, o1, o2, sz in sorted(log, key=lambda r: r[3:]):
        history.setdefault((fd, obj), []).append((sec, sz))
    cells, entering = {}, []
    for (fd, _), h in history.items():
        again = [(h[i][0] - h[i - 1][0], h[i][1], i) for i in range(1, len(h))]
        for t, sz, i in again:
            cell = cells.setdefault((fd, t), [0] * 4)
            if i == 1:
                cell[2] += sz
                cell[3] += 1
            else:
                cell[0] += 1
                cell[1] += sz
        if again:
            entering.append((fd, min(x[0] for x in again), max(x[1] for x in again)))
    return sorted(
        (fd, t, sum(s for f, m, s in entering if f == fd and m <= t),
         sum(1 for f, m, s in entering if f == fd and m <= t), *cell)
        for (fd, t), cell in cells.items())


SCHEMA = "fd_id string, obj string, sec long, ord1 long, ord2 long, sz long"


def test_rows_with_and_without_hot_objects(spark):
    log = random_log(random.Random(4), 900)
    df = spark.createDataFrame(log, SCHEMA)
    objects = a.object_totals(df)
    want = by_hand(log)
    assert rows_of(a.rows_from_log(df, objects)) == want
    split = a.rows_from_log(df, objects, hot_accesses=3, stretches=8)
    assert rows_of(split) == want
    again = linked(split.select(ROW_COLS))
    cols = [*ROW_COLS, *LINK_COLS]
    key = lambda r: r[:2]
    assert sorted(map(tuple, split.select(cols).collect()), key=key) == sorted(
        map(tuple, again.select(cols).collect()), key=key)


def test_headers(spark):
    log = random_log(random.Random(5), 300)
    d = a.descriptors_from_log(spark.createDataFrame(log, SCHEMA), 2)
    for h in d.headers.collect():
        mine = [r for r in log if r[0] == h.fd_id]
        first = {}
        for r in sorted(mine, key=lambda r: r[3:]):
            first.setdefault(r[1], r[5])
        slots = {}
        for r in mine:
            slots.setdefault(r[2] * 2 // 300, []).append(r[5])
        assert h.total_requests == len(mine)
        assert h.total_served_bytes == sum(r[5] for r in mine)
        assert h.duration == 2 * (max(r[2] for r in mine) - min(r[2] for r in mine))
        assert h.total_mib == sum(first.values()) // 1000
        assert h.unique_objects == len(first)
        assert h.peak_requests_300s == max(map(len, slots.values()))
        assert h.peak_bytes_300s == max(map(sum, slots.values()))


def test_objects_are_counted_only_where_some_may_be_hot(spark):
    log = random_log(random.Random(14), 300)
    df = spark.createDataFrame(log, SCHEMA)
    unread = a.object_totals(df).withColumn("n", F.raise_error(F.lit("looked at")).cast("long"))
    assert rows_of(a.rows_from_log(df, unread)) == by_hand(log)


def test_tasks_grow_with_the_log(spark, monkeypatch):
    log = random_log(random.Random(15), 950)
    df = spark.createDataFrame(log, SCHEMA)
    objects = a.object_totals(df)
    monkeypatch.setattr(a, "ROWS_PER_TASK", 100)
    assert a.numbered_accesses(df, objects).rdd.getNumPartitions() == 10
    assert rows_of(a.rows_from_log(df, objects)) == by_hand(log)


def test_headers_of_hot_and_single_objects(spark):
    """Also of nulls: the headers counted with the rows are those of the objects' totals."""
    log = random_log(random.Random(16), 400)
    log += [("a", None, 7, 7, i, 5) for i in range(6)] + [("a", "null size", 9, 9, 0, None), ("c", "once", 1, 1, 0, 8)]
    log += [(None, "no class", 3, 3, 0, 4), ("a", "null time", None, None, 0, 3), ("a", "null time", None, None, 1, 9)]
    df = spark.createDataFrame(log, SCHEMA)
    whole = a.descriptors_from_log(df, 2)
    split = a.descriptors_from_log(df, 2, hot_accesses=3, stretches=8)
    key = lambda r: tuple((x is not None, x) for x in r)
    told = a.headers_from_log(df, a.object_totals(df), whole.rows, 2)
    every = [sorted((tuple(r) for r in h.collect()), key=key) for h in (whole.headers, split.headers, told)]
    assert every[0] == every[1] == every[2]
    assert {r[0]: r[5] for r in every[0]}["a"] == len({r[1] for r in log if r[0] == "a"})


def test_stream_equals_batch(spark, tmp, monkeypatch):
    rng = random.Random(6)
    lines, log, at = [], [], 0
    for i in range(400):
        at += rng.randint(0, 9)
        fd, obj, sz = rng.choice(["7", "8"]), f"o{rng.randint(0, 30)}", rng.randint(1, 99)
        lines.append(f"k:{at}:{obj}:{sz * 2}:{sz}:55:{fd}:3600")
        log.append((fd, obj, at, at, sz, sz))
    lines.insert(100, "not a log line")
    for part in range(4):
        spark.createDataFrame([(x,) for x in lines[part * 101:(part + 1) * 101]], "value string") \
            .coalesce(1).write.mode("append").text(f"{tmp}/in")
    monkeypatch.setattr(live, "COMPACT_AFTER", 2)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp}/in")
    live.start(stream, f"{tmp}/table", f"{tmp}/checkpoint", buckets=4).awaitTermination()
    table = live.LiveTable(spark, f"{tmp}/table", 4)
    got = rows_of(a.rows_from_traffic(table.finished()))
    df = spark.createDataFrame(log, SCHEMA)
    assert got == rows_of(a.rows_from_log(df, a.object_totals(df)))
    assert [tuple(r) for r in table.rejects().collect()] == [("not a log line", "too few fields")]
    assert df.agg(F.count("*")).first()[0] == 400
    # two versions of a bucket at most, and sums in place of old changes
    assert all(len(v) <= 2 for v in table._versions(99).values())
    assert len(table._sums()) == 1 and len(table._changes()) < 2


def test_late_lines_are_rejected_and_change_nothing(spark, tmp):
    batches = [["k:10:x:1:5:0:7:0", "k:30:x:1:6:0:7:0"], ["k:20:x:1:7:0:7:0", "k:29:y:1:8:0:7:0"],
               ["k:30:x:1:9:0:7:0", "k:9:y:1:1:0:7:0", "k:40:y:1:2:0:7:0"]]
    for part in batches:
        spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.mode("append").text(f"{tmp}/in")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp}/in")
    live.start(stream, f"{tmp}/table", f"{tmp}/checkpoint", buckets=2).awaitTermination()
    table = live.LiveTable(spark, f"{tmp}/table", 2)
    assert sorted(r["value"] for r in table.rejects().collect()) == ["k:20:x:1:7:0:7:0", "k:9:y:1:1:0:7:0"]
    log = [("7", "x", 10, 0, 0, 5), ("7", "x", 30, 1, 0, 6), ("7", "y", 29, 0, 0, 8), ("7", "x", 30, 2, 0, 9),
           ("7", "y", 40, 3, 0, 2)]
    df = spark.createDataFrame(log, SCHEMA)
    assert rows_of(a.rows_from_traffic(table.finished())) == rows_of(a.rows_from_log(df, a.object_totals(df)))


def test_a_batch_that_runs_again_changes_nothing(spark, tmp):
    table = live.LiveTable(spark, f"{tmp}/table", 2)

    def batch(number, lines):
        df = spark.createDataFrame([(x,) for x in lines], "value string")
        live._outcome(live._met(df, table, number)).write.mode("overwrite").partitionBy(
            "kind", "bucket").parquet(table.folder(number))
        table.tidy(number)

    parts = [["k:1:x:1:5:0:7:0"], ["k:3:x:1:6:0:7:0"], ["k:4:x:1:6:0:7:0", "k:4:y:1:6:0:7:0"]]
    for number, lines in enumerate(parts):
        batch(number, lines)
        once = sorted(map(tuple, table.finished().collect()))
        batch(number, lines)
        assert sorted(map(tuple, table.finished().collect())) == once
    assert once == [("7", 1, 1, 6, 0, 0, 1, 6), ("7", 2, 0, 0, 6, 1, 0, 0)]


def windows_by_hand(log, fd, w):
    """Mean number and size of the objects in all windows of w units."""
    mine = [r for r in log if r[0] == fd]
    start, end = min(r[2] for r in mine), max(r[2] for r in mine)
    size = {}
    for r in mine:
        size[r[1]] = max(size.get(r[1], 0), r[5])
    number = total = 0
    starts = range(start, end - w + 2)
    for x in starts:
        seen = {r[1] for r in mine if x <= r[2] < x + w}
        number += len(seen)
        total += sum(size[o] for o in seen)
    return total // len(starts), number // len(starts)


def test_average_footprint_against_all_windows(spark):
    rng = random.Random(12)
    log = [(rng.choice("ab"), f"o{rng.randint(0, 12)}", rng.randint(100, 180), 0, i, rng.randint(1, 900))
           for i in range(120)]
    log = [(fd, o, sec, sec, i, sz) for fd, o, sec, _, i, sz in log] + [("c", "one", 5, 5, 0, 3), ("c", "one", 5, 5, 1, 4)]
    d = a.descriptors_from_log(spark.createDataFrame(log, SCHEMA), footprint="average")
    rows = d.rows.collect()
    assert rows and any(r["delta_t"] == 0 for r in rows)
    for r in rows:
        assert (r["mb"], r["objcount"]) == windows_by_hand(log, r["fd_id"], r["delta_t"]), r
    # the traffic is that of the other footprint
    other = a.descriptors_from_log(spark.createDataFrame(log, SCHEMA))
    cols = ["fd_id", "delta_t", *ROW_COLS[4:]]
    assert sorted(map(tuple, d.rows.select(cols).collect())) == sorted(map(tuple, other.rows.select(cols).collect()))
