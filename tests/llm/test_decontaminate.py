import hashlib
import re

import pytest

from spoor.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                owners = windows.get(tuple(w[i : i + size]))
                if owners:
                    hit |= set(range(i, i + size))
                    found |= owners
        out.append((repr(doc), len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def result(docs, items, **options):
    found = decontaminate.contamination(docs, items, **options).collect()
    return sorted((repr(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"],
                   r["items_sha256"], r["contaminated"]) for r in found)


@pytest.fixture(scope="module")
def items(spark, small):
    return spark.read.parquet(f"{small}/benchmark.parquet")


@pytest.fixture(scope="module")
def edge_items(spark):
    return spark.createDataFrame(
        [(1, "Same WORDS here"), (2, "emoji"), (3, None), (4, "..."), (None, "lost words"),
         (5, "a b c d e a b c d e a b"), (5, "emoji 😀😀"), (6, "word " * 12), (7, "same words here")],
        "item_id long, text string")


def test_against_windows(docs, items):
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    named = [tuple(r) for r in items.select("item_id", "text").collect()]
    want = brute(pairs, named)
    assert sum(w[5] for w in want) > 0
    assert result(docs, items) == want


@pytest.mark.parametrize("chars", [8_000_000, 12])
def test_edges_and_blocks(edge, edge_items, chars):
    pairs = [tuple(r) for r in edge.select("doc_id", "text").collect()]
    named = [tuple(r) for r in edge_items.where("item_id IS NOT NULL").collect()]
    assert result(edge, edge_items, block_chars=chars) == brute(pairs, named)


def test_empty_tables(edge, edge_items):
    assert decontaminate.contamination(edge.limit(0), edge_items).count() == 0
    found = decontaminate.contamination(edge, edge_items.limit(0))
    assert found.count() == edge.count() and found.where("contaminated").count() == 0


def test_longest_matches_and_cleaning(spark):
    item = " ".join(f"w{i}" for i in range(25))
    frame = spark.createDataFrame(
        [(1, "x y " + " ".join(f"w{i}" for i in range(3, 20)) + " z"), (2, "nothing here")],
        "doc_id long, text string")
    items = spark.createDataFrame([("q", item)], "item_id string, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(frame, items).collect()}
    assert [tuple(m) for m in got[1]["matches"]] == [("q", 2, 17)] and got[1]["longest"] == 17
    assert [r["doc_id"] for r in decontaminate.cleaned(frame, items).collect()] == [2]


def test_items_without_id_are_searched(spark):
    quoted = "one two three four five six seven eight nine ten eleven"
    frame = spark.createDataFrame([(1, f"so {quoted} it goes"), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(None, quoted), (None, None)], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(frame, items).collect()}
    assert [got[1][c] for c in ("n_hit", "n_items", "contaminated", "longest")] == [11, 1, True, 11]
    assert got[1]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert not got[2]["contaminated"]
    assert [r["doc_id"] for r in decontaminate.cleaned(frame, items).collect()] == [2]
