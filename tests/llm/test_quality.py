import re
from collections import Counter

import pytest

from spoor.llm import quality


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def failed(n):
    return n[0] < 10 or 100 * n[4] > 20 * n[0]


def test_measures(edge, docs):
    for frame in (edge, docs):
        rows = frame.select("doc_id", "text").collect()
        want = sorted((repr(i), *measures(t), failed(measures(t))) for i, t in rows)
        got = sorted((repr(r["doc_id"]), *[r[m] for m in quality.MEASURES], r["base_failed"])
                     for r in quality.quality(frame).collect())
        assert got == want


def test_bad_host_goes(spark):
    good = " ".join(f"w{i}" for i in range(30))
    bad = " ".join("#" * 9 for _ in range(12)) + " " + good
    rows = [(i, good, "good") for i in range(40)] + [(100 + i, bad, "bad") for i in range(40)]
    rows += [(200, good, "bad"), (300, bad, "tiny"), (301, "few", "good"), (302, good, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(frame).collect()}
    assert all(kept[i] for i in range(40)) and kept[302]
    assert not any(kept[100 + i] for i in range(40)) and not kept[200] and not kept[301]
    left = quality.filtered(frame)
    assert left.columns == frame.columns
    assert {r["doc_id"] for r in left.collect()} == {i for i, k in kept.items() if k}


def test_prior_shrinks():
    alpha, beta = quality.beta_prior(20, 0.1, 0.02, 0.01)
    assert alpha / (alpha + beta) == pytest.approx(0.1)
    assert 1 <= alpha + beta <= 1000
    assert sum(quality.beta_prior(1, 0.3, 0.0, 1.0)) == pytest.approx(1000)


def test_empty(edge):
    assert quality.quality(edge.limit(0)).count() == 0
    assert quality.filtered(edge.limit(0)).count() == 0
