import hashlib

import pytest
from pyspark.sql import functions as F

from spoor.llm import manifest


def H(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more: int = 0) -> str:
    out = []
    for c in manifest.COLUMNS:
        v = row[c]
        if c == "n_chars" and v is not None:
            v += more
        v = None if v is None else str(v)
        out.append("-" if v is None else f"{len(v.encode())}:{v}")
    return H(*out)


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, at: int) -> list[tuple[str, str]]:
    out = []
    for level in tree[:-1]:
        beside = at ^ 1
        out.append(("O", "") if beside >= len(level) else ("RL"[beside < at], level[beside]))
        at //= 2
    return out


def plain(rows) -> list[tuple]:
    groups: dict = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))):
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: levels([leaf(r) for r in groups[g]]) for g in names}
    upper = levels([trees[g][-1][0] for g in names])
    out = []
    for g, name in enumerate(names):
        for i, r in enumerate(groups[name]):
            hops = way(trees[name], i) + way(upper, g)
            for more in (0, 1):
                now = leaf(r, more)
                for side, beside in hops:
                    now = H(beside, now) if side == "L" else H(now, beside) if side == "R" else H(now)
                if more == 0:
                    assert now == upper[-1][0]
            changed = leaf(r, 1) != leaf(r)
            out.append((r["doc_id"], leaf(r), trees[name][-1][0], upper[-1][0],
                        H(*[x for _, x in hops]), now, not changed))
    return out


def found(df, **options) -> list[tuple]:
    columns = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in manifest.COLUMNS]
    rows = manifest.verified(manifest.manifest(df, more={"seen": manifest.leaf(columns)}, **options))
    return [tuple(r) for r in rows.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


SCHEMA = ("doc_id long, source string, lang string, n_chars long, text string, tree long, "
          "level int, at long, hops binary, digest binary, total long")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, b"4", b"5", 6) for r in rows], SCHEMA)


def same(df, **options):
    assert sorted(found(df, **options), key=repr) == sorted(plain(df.collect()), key=repr)


@pytest.mark.parametrize("span", [1, 2, 10])
@pytest.mark.parametrize("sizes", [[1], [2], [3], [1, 1], [5, 1, 8], [7, 33, 2, 1, 16]])
def test_shapes_of_trees(spark, span, sizes):
    rows = [(i, "s", f"l{g}", i, f"text {i}") for g, n in enumerate(sizes) for i in range(n)]
    if span != 10 and sizes not in ([5, 1, 8], [7, 33, 2, 1, 16]):
        pytest.skip("covered by the larger ones")
    same(frame(spark, rows), span=span)


def test_edges(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "", 0, ""),
            (1, "", "", 0, ""), (1, "s", "", 1, "other row of one id"), (-5, "s", "é", 3, "x" * 300_000),
            (2, "s", "é", None, "😀 ß"), (3, None, "zz", 7, None), (4, "-", "zz", 7, "-")]
    same(frame(spark, rows), span=2)


def test_one_group_over_many_tasks(spark):
    same(frame(spark, [(i * 7919 % 3001, "s", "en" if i % 3 else None, i, f"t{i}") for i in range(700)]), span=3)


def test_empty_table(spark):
    assert found(frame(spark, [])) == []


def test_changed_rows_are_told(spark, docs):
    """Every changed leaf misses the root and no other does."""
    hit = F.col("doc_id") % 5 == 0
    columns = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in manifest.COLUMNS]
    rows = manifest.manifest(docs, more={"seen": F.when(hit, manifest.leaf(columns))})
    rows = manifest.verified(rows.withColumn("seen", F.coalesce("seen", "leaf")))
    assert rows.where(F.col("verified") == hit).count() == 0
    assert rows.count() == docs.count()
