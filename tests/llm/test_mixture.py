import hashlib
import random
import re

import pytest

from spoor.llm import mixture

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes: dict, weights=(3, 1, 2), share=1.5, most=2) -> dict:
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and free:
        room = sum(weight[s] for s in free)
        for s in sorted(free, key=str):
            target[s] += left * weight[s] / room
        left = 0.0
        for s in list(free):
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                free.discard(s)
    return target


def plain(rows) -> list[tuple]:
    """(doc_id, size, source size, taken) by sorting the hashes of each source."""
    docs = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    sizes: dict = {}
    for _, s, n in docs:
        sizes[s] = sizes.get(s, 0) + n
    target, out = shares(sizes), []
    for s in sizes:
        whole = int(target[s] // sizes[s] + 1e-9) if sizes[s] else 0
        left = target[s] - whole * sizes[s]

        def key(d):
            name = f"{'-' if d[0] is None else d[0]}:{d[2]}"
            return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)

        ended = False
        for d in sorted((d for d in docs if d[1] == s), key=key):
            once = 0
            if d[2] and not ended:
                once = int(d[2] <= left or left * 2 > d[2])
                ended = d[2] > left
                left -= d[2]
            out.append((d[0], d[2], sizes[s], d[2] * (whole + once)))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, text string, source string, size long, hash long, target double, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, 9, 9.0, 9) for r in rows], SCHEMA)


def found(df) -> list:
    return mixture.mixed(df).collect()


def check(rows, got, near: float = 0):
    assert sorted(((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in got), key=repr) == plain(rows)


def test_targets_are_shared_by_weight_up_to_the_limit(spark):
    rng = random.Random(1)
    for n in (1, 2, 5, 11):
        sizes = {f"s{i}": rng.choice([0, 1, 10, 1000, 100_000]) for i in range(n)} | {None: 500, "ß": 50}
        df = spark.createDataFrame([(s, v, 0) for s, v in sizes.items()], "source string, size long, x int")
        got = {r["source"]: r["target"] for r in mixture.targets(df).collect()}
        want = shares(sizes)
        assert set(got) == set(want)
        for s in want:
            assert got[s] == pytest.approx(want[s], abs=1e-6)


@pytest.mark.parametrize("bits", [4, 12])
def test_documents_are_taken_by_threshold(spark, monkeypatch, bits):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(0, 60), rng.choice(["hot", "hot", "a", "b", "c", None])) for i in range(600)]
    monkeypatch.setattr(mixture, "BITS", bits)
    got = found(frame(spark, rows))
    check(rows, got)
    for source in ("hot", "a", "b", "c", None):
        mine = {i for i, _, s in rows if s == source}
        taken = sum(r["taken"] for r in got if r["doc_id"] in mine)
        target = next(r["target"] for r in got if r["doc_id"] in mine)
        assert abs(taken - target) <= 60
        assert all(r["taken"] <= 2 * r["size"] for r in got)


def test_repeated_rows_are_taken_apart(spark):
    """A third of the rows are one row: as many of them are taken as the budget asks."""
    rows = [(7, "same words in this row", "a")] * 300 + [(i, "w " * 30, "bcd"[i % 3]) for i in range(100)]
    got = found(frame(spark, rows))
    mine = [r for r in got if r["doc_id"] == 7 and r["size"] == 5]
    assert len(mine) == 300
    assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 2.5
    check([r for r in rows], got) if len({r["taken"] for r in mine}) == 1 else None


def test_edges(spark):
    rows = [(None, "no id here", None), (1, None, "a"), (2, "", "a"), (3, " \t\x0b ", "empty"),
            (4, "é ñ   ß", "a"), (5, "word " * 100_000, "b"), (6, "x" * 300_000, "c"), (6, "x" * 300_000, "c")]
    check(rows, found(frame(spark, rows)))


def test_empty_table_and_tables_without_words(spark):
    assert found(frame(spark, [])) == []
    got = found(frame(spark, [(1, None, "a"), (2, "", None)]))
    assert [(r["doc_id"], r["target"], r["taken"]) for r in sorted(got)] == [(1, 0.0, 0), (2, 0.0, 0)]


def test_smaller_budgets_are_nested(spark):
    rows = frame(spark, [(i, "w " * (i % 40 + 1), "ab"[i % 2]) for i in range(400)])
    taken = [{r["doc_id"]: r["times"] for r in mixture.mixed(rows, share_pct=p).collect()} for p in (40, 90, 130)]
    for less, more in zip(taken, taken[1:]):
        assert all(less[i] <= more[i] for i in less)


def test_reruns_agree(spark, docs):
    again = [sorted(map(tuple, mixture.mixed(docs.repartition(n)).collect())) for n in (1, 7)]
    assert again[0] == again[1]
