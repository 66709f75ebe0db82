import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spoor.llm import ngram_join as nj
from spoor.llm.components import components


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(5, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows):
    """Components over all pairs of texts with similarity of 0.8 or more."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    seen = set()
    for members in holders.values():
        for a in members:
            for b in members:
                if a < b and (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                        root[find(b)] = find(a)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((repr(d), len(s), repr(d if not s else least.get(find(i))))
                  for i, ((d, _), s) in enumerate(zip(rows, sets)))


def check(frame):
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    got = sorted((repr(r[0]), r[1], repr(r[2])) for r in nj.similar(frame).collect())
    assert got == brute(rows)


def near_copies(seed, groups=12):
    rnd = random.Random(seed)
    quoted = [f"q{i}" for i in range(60)]
    rows = []
    for _ in range(groups):
        n = rnd.choice([6, 9, 12, 20, 33, 40, 70, 150, 400, 1100])
        base = [f"w{rnd.randrange(3000)}" for _ in range(n)]
        if rnd.random() < 0.5:
            base[n // 2 : n // 2] = quoted
        for _ in range(rnd.randrange(1, 9)):
            words = list(base)
            for _ in range(rnd.randrange(0, max(2, n // 25))):
                at = rnd.randrange(len(words))
                words[at : at + 1] = rnd.choice([[], [f"x{rnd.randrange(999)}"], [words[at].upper(), "y"]])
            rows.append(" ".join(words))
    rnd.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies(spark, seed):
    check(spark.createDataFrame(near_copies(seed, 40), "doc_id long, text string"))


def test_documents_and_edges(edge, docs):
    check(edge)
    check(docs)


def test_every_similar_pair_shares_a_bucket():
    """The entries themselves: of two linked sets the smaller one probes what the other files."""
    rng = np.random.default_rng(3)
    for n in [4, 5, 9, 20, 26, 31, 32, 51, 63, 64, 90, 127, 128, 400, 511, 700, 1024, 3000]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            spare = nj.differences(len(a), len(a) * 100 // 80)
            cut = int(rng.integers(0, spare + 1))
            most = max(0, (20 * len(a) - 100 * cut + 0) // 80) if 100 * (len(a) - cut) >= 80 * len(a) else 0
            b = np.unique(np.concatenate([rng.permutation(a)[: len(a) - min(cut, len(a) // 5)],
                                          rng.integers(0, 2**63, max(0, most), dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common) or len(b) < 4:
                continue
            out, short = nj.entries([a, b], 0, np.ones(2, bool))
            assert not short.any()
            files, probes = [set(), set()], [set(), set()]
            for key, owner, role in out:
                for k, o in zip(key.tolist(), owner.tolist()):
                    if role & nj.INDEX:
                        files[o].add(k)
                    if role & nj.PROBE:
                        probes[o].add(k)
            small, large = (0, 1) if len(a) <= len(b) else (1, 0)
            assert probes[small] & files[large], (len(a), len(b))


def test_one_deletion_units_replace_common_segments():
    rng = np.random.default_rng(5)
    quoted = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate([quoted, rng.integers(0, 2**63, 150, dtype=np.uint64)]))
            for _ in range(40)]
    s = nj.Segments(sets, 9, 0, np.full(40, 1 << 30))
    common = np.unique(s.exact, return_counts=True)
    need = np.array([nj.band(9).units(len(x)) for x in sets])
    exact, double, short = nj.picked(s, need, (common[0], common[1] - 1), 0)
    assert not short.any() and len(double)
    assert (np.bincount(s.owner[exact], minlength=40) + np.bincount(s.owner[double], minlength=40) == need).all()


def test_parity_never_exceeds_the_differences():
    rng = np.random.default_rng(9)
    for n, m in ((10, 3), (400, 90), (3000, 900)):
        a = rng.integers(0, 2**63, n, dtype=np.uint64)
        b = np.concatenate([a[m:], rng.integers(0, 2**63, m, dtype=np.uint64)])
        odd = [np.unpackbits(nj.parity(np.unique(x)).view(np.uint8)) for x in (a, b)]
        assert 0 < (odd[0] ^ odd[1]).sum() <= 2 * m


def test_a_text_and_many_edited_copies(spark):
    """Copies that are linked with the text but not with each other."""
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = [(1000, " ".join(base))]
    for i in range(60):
        words = list(base)
        for at in rnd.sample(range(0, 200, 6), 4 if i % 3 else 6):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_reach_never_falls():
    for number in range(6, 18):
        b = nj.band(number)
        assert (np.diff(b.reach(np.arange(b.least, b.top + 1))) >= 0).all()


def test_second_hashes_where_units_lack(spark, monkeypatch):
    monkeypatch.setattr(nj.Band, "reach", lambda self, sizes: np.full(
        len(sizes), int(self.segments * 0.9), np.int64))
    rows = near_copies(7)
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_copies_in_many_tasks_file_once(spark):
    """Copies of texts that share segments meet once per bucket, however many tasks filed them."""
    rnd = random.Random(6)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(4):
        words = list(base)
        for at in rnd.sample(range(300), 24):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    rows = [(i, t) for i, t in enumerate(texts * 8)] + [(7, texts[3])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    own = frame.withColumn("text_hash", F.xxhash64("text")).withColumn(
        "spread", F.xxhash64("doc_id", "text_hash"))
    shared = nj._shared(own, 0)
    filed = shared.where(~F.col("role").isin(nj.DOCUMENT, nj.SHORT))
    assert filed.count() == filed.select("key", "id").distinct().count() > 0
    assert shared.where(F.col("role") == nj.DOCUMENT).count() == len(rows)
    check(frame)


def test_a_set_keeps_the_roles_of_all_its_entries(spark):
    rows = [(1, 5, nj.INDEX), (1, 5, nj.INDEX | nj.PROBE), (1, 5, nj.PROBE | nj.TWICE), (1, 6, nj.INDEX),
            (2, 5, nj.DOCUMENT), (2, 5, nj.DOCUMENT), (2, 5, nj.INDEX), (5, 5, nj.SHORT)]
    got = nj._once(spark.createDataFrame(rows, "key long, id long, role int")).collect()
    assert sorted(map(tuple, got)) == [
        (1, 5, nj.INDEX | nj.PROBE | nj.TWICE), (1, 6, nj.INDEX), (2, 5, nj.DOCUMENT),
        (2, 5, nj.DOCUMENT), (2, 5, nj.INDEX), (5, 5, nj.SHORT)]


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 9), (10, 11), (11, 12), (12, 13), (13, 10), (20, 3)]
    links += [(100 + i, 101 + i) for i in range(40)]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 20: 1, 4: 4, 5: 4, 10: 10, 11: 10, 12: 10, 13: 10}
    assert got == want | {i: 100 for i in range(100, 141)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_of_each(spark, edge):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (1, text + " x"), (1, text + " x"), (2, "other words"), (None, "no id"), (4, None)]
    kept = nj.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((repr(r[0]), r[1]) for r in kept.collect()) == sorted(
        (repr(i), t) for i, t in [(1, text + " x"), (2, "other words"), (None, "no id"), (4, None)])
    assert nj.one_of_each(edge).columns == edge.columns
    assert nj.similar(edge.limit(0)).count() == 0


@pytest.mark.parametrize("most", [2_000_000, 1])
def test_texts_stay_where_they_are(spark, monkeypatch, capsys, most):
    """Up to a bound the ids that go are sent to the texts, whatever Spark's own threshold."""
    monkeypatch.setattr(nj, "SENT_IDS", most)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, " ".join(f"w{i % 5}_{k}" for k in range(50))) for i in range(20)] + [(None, "no id")]
        kept = nj.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
        kept.explain()
        assert ("BroadcastHashJoin" in capsys.readouterr().out) == (most > 1)
        assert sorted(repr(r[0]) for r in kept.collect()) == ["0", "1", "2", "3", "4", "None"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
