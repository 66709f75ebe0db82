import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spoor.llm import queries, urls

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

EDGE = [None, "", "no scheme", "http://", "HTTP://A.Net/x", "http://net/", "http://net", "x://example.net/en/",
        "http://a.example.net/en/?q=1#f", "http://b.example.net/enx", "http://notexample.com/de/",
        "http://example.com/de/1", "a://b://c.net/d", "http://İ.NET/Ü", "http://x.org/fr/../#a?b",
        "http://h.com?x=/de/", "http://h.com#y", "http://user@e.org/fr/", "http://x.org/FR/"]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def judge(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def check(found, pages):
    got = Counter(tuple(r) for r in found.select("page_id", "host", "path", "rule").collect())
    want = Counter((i, *parse(u), judge(*parse(u))[0]) for i, u in pages)
    assert got == want
    for r in found.where("rule IS NOT NULL").collect():
        assert r["verdict"] == judge(r["host"], r["path"])[1]


def test_fixed_rules(spark, small):
    rows = [(i, u, "extra", "extra") for i, u in enumerate(EDGE)] + [(1, "http://net/", "", "")] * 2
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, tokens string")
    none = spark.createDataFrame([], "url string, block boolean")
    found = urls.filtered(frame, queries.URL_RULES, none)
    check(found, [r[:2] for r in rows])
    assert found.where("rule IS NULL AND verdict <> 'allow'").count() == 0
    pages = spark.read.parquet(f"{small}/pages.parquet")
    check(queries.op8_url_filter(spark, small), [tuple(r) for r in pages.select("page_id", "url").collect()])


def brute_rules(rows, least, confidence):
    """All sets of classes that go with block often enough, less those with a rule inside;
    a class: the tokens that occur in the same rows, named by the first."""
    where = {}
    for i, (t, _) in enumerate(rows):
        for x in t:
            where.setdefault(x, set()).add(i)
    name = {x: min(y for y in where if where[y] == where[x]) for x in where}
    rows = [({name[x] for x in t}, b) for t, b in rows]
    rules = set()
    every = {s for t, _ in rows for n in range(1, len(t) + 1)
             for s in itertools.combinations(sorted(t), n)}
    for s in every:
        holding = [b for t, b in rows if set(s) <= t]
        if sum(holding) >= least and sum(holding) >= confidence * len(holding):
            rules.add(s)
    return {s for s in rules if not any(set(o) < set(s) for o in rules)}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = []
    for i in range(120):
        host, part = ("spam", "good", "mixed")[i % 3], ("buy", "read")[i // 3 % 2]
        bad = host == "spam" or (host == "mixed" and part == "buy")
        rows.append((f"http://{host}.org/{part}/{i}?ref=1", bad if i % 10 else None))
    return spark.createDataFrame(rows, "url string, block boolean")


def test_mined_rules_against_all_combinations(spark, labelled):
    rows = [(r["t"], r["block"]) for r in labelled.where("block IS NOT NULL").select(
        urls.tokens(F.col("url")).alias("t"), "block").collect()]
    got = urls.mined(labelled, 6, 0.9).rules.collect()
    assert {tuple(r["classes"]) for r in got} == brute_rules(rows, 6, 0.9)
    assert got and all(r["key"] in r["classes"] and r["rows"] >= 6 for r in got)


def test_method_judges_what_rules_do_not(spark, labelled):
    pages = spark.createDataFrame(
        [(1, "http://spam.org/other"), (2, "http://good.org/buy/"), (3, "https://mixed.org/buy/9"),
         (4, "http://spam.org/fr/1"), (5, None)], "page_id long, url string")
    found = urls.filtered(pages, queries.URL_RULES, labelled, min_rows=6, min_confidence=0.9)
    assert {r["page_id"]: r["verdict"] for r in found.collect()} == {
        1: "block", 2: "allow", 3: "block", 4: "allow", 5: "allow"}
    assert urls.filtered(pages.limit(0), queries.URL_RULES, labelled).count() == 0


def test_urls_of_many_parts(spark):
    """Copies of a URL of 40 parts, and URLs that hold ever fewer of its parts."""
    long = "http://deep.org/" + "/".join(f"p{i}" for i in range(40))
    rows = [(long, True)] * 30 + [("http://fine.org/", False)] * 30
    rows += [("http://deep.org/" + "/".join(f"p{i}" for i in range(n)), True) for n in range(1, 40)]
    labelled = spark.createDataFrame(rows, "url string, block boolean")
    pages = spark.createDataFrame([(1, long), (2, "http://deep.org/x"), (3, "http://fine.org/p39"),
                                   (4, "http://fine.org/")], "page_id long, url string")
    found = urls.filtered(pages, queries.URL_RULES, labelled, min_rows=5)
    assert {r["page_id"]: r["verdict"] for r in found.collect()} == {
        1: "block", 2: "block", 3: "block", 4: "allow"}


def test_few_labels_make_no_rule(spark, labelled):
    few = labelled.limit(urls.MIN_ROWS - 1)
    assert urls.mined(few).rules.count() == 0


def test_rules_of_more_classes_than_growth_lists(spark):
    """URLs of up to 13 classes: all rules, also those of classes that go least with block."""
    rng = random.Random(8)
    rows = []
    for i in range(240):
        parts = [f"p{k:02}" for k in range(13) if rng.random() < (0.3, 0.8)[k < 6]]
        if i % 6 == 0:
            parts = sorted({*parts, "p11", "p12"})
        bad = {"p11", "p12"} <= set(parts) or rng.random() < 0.45
        rows.append((f"http://{i}/" + "/".join(parts), bad))
    labelled = spark.createDataFrame(rows, "url string, block boolean")
    held = [(r["t"], r["block"]) for r in labelled.select(urls.tokens(F.col("url")).alias("t"), "block").collect()]
    assert max(len(t) for t, _ in held) > urls.MOST_CLASSES
    want = brute_rules([([x for x in t if x.startswith("path:")], b) for t, b in held], 20, 0.8)
    got = urls.mined(labelled).rules.collect()
    assert {tuple(r["classes"]) for r in got} == want and ("path:p11", "path:p12") in want
    for bound in (1, 13):
        rules = urls.mined(labelled, most_classes=bound).rules
        assert sorted(map(tuple, rules.collect())) == sorted(map(tuple, got))


def test_levels_end_where_rows_tell_no_more_apart(spark):
    """40 parts, each URL holding those of a shorter one, none a rule by itself: every
    subset of them is frequent."""
    rows = [("http://deep.org/" + "/".join(f"p{i}" for i in range(n)), b)
            for n in range(1, 41) for b in (True, False, True, False)]
    rows += [("http://deep.org/" + "/".join(f"p{i}" for i in range(40)), i % 2 == 0) for i in range(60)]
    labelled = spark.createDataFrame(rows, "url string, block boolean")
    assert urls.mined(labelled).rules.count() == 0
