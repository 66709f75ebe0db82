import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spoor.llm import blocks, hmm, queries


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def held():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


def check(frame, got):
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    c = Counter(w for i, t in rows if not held_out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((repr(i), held_out(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
                   sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tokens(t))) for i, t in rows)
    got = sorted(got, key=lambda r: (repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"],
                                     r["train_tokens"], r["base_score"]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (repr(g["doc_id"]), *list(g)[1:5]) == w[:5]
        assert g["base_score"] == pytest.approx(w[5], rel=1e-9)
        assert g["score"] < 0 and math.isfinite(g["score"])


def test_base_scores(edge, docs):
    check(edge, hmm.scores(edge, held(), rounds=1).collect())
    check(docs, hmm.scores(docs, held(), rounds=1).collect())


def test_better_than_unigram_on_held_out_documents(spark, small):
    total = queries.op9_language_model(spark, small.replace("0.001", "0.01")).where("held_out").agg(
        F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert total[1] > total[0]


def every_path(m, seq):
    states = len(m.start)
    return sum(
        np.prod([m.start[p[0]] * m.emits[seq[0], p[0]]]
                + [m.moves[a, b] * m.emits[s, b] for a, b, s in zip(p, p[1:], seq[1:])])
        for p in itertools.product(range(states), repeat=len(seq)))


@pytest.fixture
def model():
    rng = np.random.default_rng(1)
    moves, emits = rng.random((2, 2)), rng.random((3, 2))
    return hmm.Model(np.array([0.3, 0.7]), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))


SEQS = [np.array(s) for s in ([0, 1, 2, 1], [2], [1, 1, 0], [0, 0, 0, 0, 2, 1])]


def test_likelihood_sums_all_paths(model):
    got = hmm.likelihood(model, SEQS)
    assert got == pytest.approx([math.log(every_path(model, s)) for s in SEQS])


def test_expected_counts_of_all_paths(model):
    start, moves, emits, loglik = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2)), 0.0
    for seq in SEQS:
        whole = every_path(model, seq)
        loglik += math.log(whole)
        for p in itertools.product(range(2), repeat=len(seq)):
            w = model.start[p[0]] * model.emits[seq[0], p[0]]
            for a, b, s in zip(p, p[1:], seq[1:]):
                w *= model.moves[a, b] * model.emits[s, b]
            w /= whole
            start[p[0]] += w
            for a, b in zip(p, p[1:]):
                moves[a, b] += w
            for k, s in zip(p, seq):
                emits[s, k] += w
    got = hmm.expected(model, SEQS, 3)
    for g, w in zip(got, (start, moves, emits, loglik)):
        assert np.allclose(g, w)


def test_rounds_raise_the_likelihood(docs):
    rows = hmm.input_rows(docs, held(), "doc_id", "text")
    table = blocks.cut(rows, hmm.words, counted=True)
    v = hmm.vocabulary(table, rows, most=256)
    seqs = hmm.sequences(table, v).df
    texts = [blocks.unpack(bytes(r[0]))[0].astype(int) for r in seqs.where("flag").select("payload").collect()]
    found = [hmm.likelihood(hmm.learned(seqs, v, rounds=n), texts).sum() for n in (0, 1, 3)]
    assert found == sorted(found)
    assert hmm.initial(v).emits.sum(0) == pytest.approx(np.ones(hmm.STATES))


def test_empty_and_untrained(edge, spark):
    assert hmm.scores(edge.limit(0), held()).count() == 0
    got = hmm.scores(edge, F.lit(True)).collect()
    assert {r["train_tokens"] for r in got} == {0} and all(r["n_known"] == 0 for r in got)


def test_rare_words_have_emissions_of_their_own(spark):
    """Words of one length and count, each behind one of two frequent words: a text that
    keeps to this is likelier than one that doesn't."""
    word = lambda kind, i: f"{kind}{i:05d}"
    text = lambda lead, kind, at: " ".join(f"{lead} {word(kind, i)}" for i in range(at, at + 50))
    rows = [(2 * n + k, text(lead, kind, 50 * (n // 3))) for n in range(300)
            for k, (lead, kind) in enumerate((("lo", "a"), ("up", "b")))]
    rows += [(-1, text("lo", "a", 100)), (-2, text("lo", "b", 100))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in hmm.scores(frame, F.col("doc_id") < 0).where("held_out").collect()}
    assert got[-1]["base_score"] == pytest.approx(got[-2]["base_score"])
    assert got[-1]["n_known"] == got[-2]["n_known"] == 101
    assert got[-1]["score"] > got[-2]["score"] + 1


def test_probabilities_of_all_words_sum_to_one(docs):
    rows = hmm.input_rows(docs, held(), "doc_id", "text")
    table = blocks.cut(rows, hmm.words, counted=True, size=20_000)
    v = hmm.vocabulary(table, rows, most=256)
    model = hmm.trained(table, table.where("bucket < 0"), v, hmm.initial(v), rounds=1)
    lists = {(r["block"], r["bucket"]): blocks.unpack_words(bytes(r["payload"]))[0]
             for r in table.where("bucket >= 0").collect()}
    found, unseen = {}, {}
    for r in model.rows.collect():
        total = blocks.unpack(bytes(r["payload"]))[0]
        for w, n, e in zip(lists[r["block"], r["bucket"]], total, hmm._cells(bytes(r["emits"]), hmm.STATES)):
            seen = (found, w) if n else (unseen, hmm.length_class(w))
            assert np.allclose(seen[0].setdefault(seen[1], e), e, rtol=1e-6)
    assert len(found) == v.types - 1
    rest = [c for c in range(hmm.CLASSES) if c not in unseen]
    total = sum(found.values()) + sum(unseen.values()) + model.end
    assert (total < 1 + 1e-4).all() and (total > 0.9).all() and len(rest) < hmm.CLASSES


def test_training_goes_on_until_nothing_is_gained(spark):
    """Symbols in runs: the states that tell them apart need more than three rounds."""
    rng = np.random.default_rng(3)
    texts = [np.append(np.repeat(rng.integers(0, 6, 40), 8), 22) for _ in range(60)]
    n = sum(map(len, texts))
    every = np.bincount(np.concatenate(texts), minlength=23)
    v = hmm.Vocabulary(n, 7, 60, {b"%d" % i: i for i in range(6)}, every[:6].tolist(), [0] * 16, [0] * 16)
    seqs = spark.createDataFrame([(True, bytearray(blocks.pack(t))) for t in texts], hmm._SEQUENCES)
    total = lambda **rounds: hmm.likelihood(hmm.learned(seqs, v, **rounds), texts).sum() / n
    assert total() > total(rounds=3) + hmm.LEAST_GAIN


def test_tasks_of_a_round_follow_the_blocks(spark, docs):
    """With many partitions and few blocks, a round of tied words and one of single words
    shuffle three times; the sums, and what is written, have no task per partition."""
    n, sc = 64, spark.sparkContext
    many = {"spark.sql.shuffle.partitions": str(n), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}

    def started(rounds):
        sc.setJobGroup(f"rounds-{rounds}", "")
        hmm.scores(docs, held(), rounds=rounds)
        sc._jsc.sc().listenerBus().waitUntilEmpty()
        told = sc.statusTracker()
        stages = {s for j in told.getJobIdsForGroup(f"rounds-{rounds}") for s in told.getJobInfo(j).stageIds}
        return sum(told.getStageInfo(s).numCompletedTasks for s in stages if told.getStageInfo(s))

    try:
        for k, v in many.items():
            spark.conf.set(k, v)
        assert 0 < started(2) - started(1) < 3 * n
        rows = hmm.input_rows(docs, held(), "doc_id", "text")
        buckets = lambda least: blocks.stored(rows, hmm.words, least=least).df.where(
            "bucket >= 0").select("bucket").distinct().count()
        assert buckets(1_000_000) == 1 and buckets(1) == buckets(0) == n
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)


def test_pieces_of_a_long_text_pass_on_their_states(model, monkeypatch):
    whole = hmm.expected(model, SEQS, 3)
    monkeypatch.setattr(hmm, "BATCH_TOKENS", 3)
    for piece in (1, 2, 3, 5):
        monkeypatch.setattr(hmm, "SPAN", piece)
        for g, w in zip(hmm.expected(model, SEQS, 3), whole):
            assert np.allclose(g, w)
        assert hmm.likelihood(model, SEQS) == pytest.approx(
            [math.log(every_path(model, x)) for x in SEQS])


def plain_training(texts, v, rounds):
    """Baum-Welch as it is written down, a word and a state at a time: first with tied words,
    then with every word alone, smoothed as the module says."""
    first, end = len(v.symbol), v.size - 1
    states = hmm.STATES
    m = hmm.initial(v)
    unigram = v.unigram()

    def passed(start, moves, emit, seqs):
        s0, mv, em, ll = np.zeros(states), np.zeros((states, states)), {}, 0.0
        for seq in seqs:
            e = [emit(x) for x in seq]
            a = [start * e[0]]
            for x in e[1:]:
                a.append((a[-1] @ moves) * x)
            b = [np.ones(states)]
            for x in reversed(e[1:]):
                b.insert(0, moves @ (x * b[0]))
            whole = a[-1].sum()
            ll += math.log(whole)
            s0 += a[0] * b[0] / whole
            for t, x in enumerate(seq):
                em[x] = em.get(x, 0) + a[t] * b[t] / whole
                if t:
                    mv += np.outer(a[t - 1], e[t] * b[t]) * moves / whole
        return s0, mv, em, ll

    def symbol(w):
        return end if w is None else v.symbol.get(w, first + hmm.length_class(w))

    def until(step, model):
        """Rounds until a round gains too little, which is the first that is told so."""
        before, done = None, 0
        while rounds is None or done < rounds:
            model, ll = step(model)
            done += 1
            if before is not None and ll - before < hmm.LEAST_GAIN * v.tokens:
                break
            before = ll
        return model

    def tied(now):
        s0, mv, em, ll = passed(now.start, now.moves, lambda x: now.emits[x],
                                [[symbol(w) for w in t] for t in texts])
        s0, mv = s0 + 0.1, mv + 0.1
        em = np.stack([em.get(i, np.zeros(states)) for i in range(v.size)]) + unigram[:, None] * v.size
        return hmm.Model(s0 / s0.sum(), mv / mv.sum(1, keepdims=True), em / em.sum(0)), ll

    m = until(tied, m)
    count = Counter(w for t in texts for w in t if w is not None)
    held, types = np.array(v.class_tokens), np.array(v.class_types)

    def alone(w):
        k = symbol(w) - first
        share = 1.0 if k < 0 else (count[w] + 1) / (held[k] + types[k] + 1)
        return m.emits[symbol(w)] * share

    words = {w: alone(w) for w in count}

    def untied(now):
        start, moves, emits, stop = now
        s0, mv, em, ll = passed(start, moves, lambda w: stop if w is None else emits[w], texts)
        of = np.zeros((hmm.CLASSES, states))
        kept = np.zeros(states)
        for w, e in em.items():
            if w is not None:
                k = symbol(w) - first
                if k < 0:
                    kept += e
                else:
                    of[k] += e
        norm = kept + of.sum(0) + em[None] + v.size
        new = {}
        for w in emits:
            k = symbol(w) - first
            if k < 0:
                new[w] = (em[w] + v.size * (count[w] + 1) / (v.tokens + v.size)) / norm
            else:
                room, more = held[k] + types[k] + 1, types[k] + 1
                whole = (of[k] + v.size * unigram[first + k]) / norm
                part = of[k] / max(held[k], 1)
                new[w] = whole * (em[w] + part + more * (count[w] + 1) / room) / (part * room + more)
        s0, mv = s0 + 0.1, mv + 0.1
        return (s0 / s0.sum(), mv / mv.sum(1, keepdims=True), new, (em[None] + v.size * unigram[-1]) / norm), ll

    start, moves, words, stop = until(untied, (m.start, m.moves, words, m.emits[end]))
    return [math.log10((lambda a: a)(forward(start, moves, [stop if w is None else words[w] for w in t])))
            for t in texts]


def forward(start, moves, emits):
    a = start * emits[0]
    for e in emits[1:]:
        a = (a @ moves) * e
    return a.sum()


def test_scores_are_those_of_plain_training(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(["to", "be", "or", "not", f"w{i}", "that", "is"], 12)) for i in range(10)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in hmm.scores(frame, F.lit(False)).collect()}
    rows = hmm.input_rows(frame, F.lit(False), "doc_id", "text")
    v = hmm.vocabulary(blocks.cut(rows, hmm.words, counted=True), rows)
    want = plain_training([[*(w.encode() for w in t.split()), None] for t in texts], v, None)
    assert [got[i] for i in range(10)] == pytest.approx(want, rel=1e-5)
