"""Hidden Markov language model of documents.

Words are emitted by latent states, every training word with probabilities of its own.
Training starts with tied words: frequent ones (at least one in ``SYMBOLS`` of the
training tokens) are symbols of their own, the others share classes by length, so that
the sums of a round are small.  From there every training word goes on alone: its expected
counts by state lie in the bucket of its hash (see ``blocks``), which sums them over the
blocks and hands each block the probabilities of its own words back.  The classes remain
as what a rare word's probability is smoothed with, and for words never counted.

Both parts are Baum-Welch over all training documents: tasks run scaled forward and
backward recursions and return expected counts, which Spark sums.  The score of a text is
the exact likelihood of its word sequence, by the scaled forward recursion.

Cases: a null or empty text is the end token alone; unknown words have the probability
of a word never counted; without training documents the model is uniform; repeated rows
count and are scored each; very long texts are scored whole, piece by piece; an empty table
gives an empty result; further columns are left aside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm import blocks
from spoor.llm.common import Batches, in_arrow
from spoor.session import Stored, materialize, store

STATES = 4
#: Training ends when a round adds less than this to the log likelihood per token (nats).
LEAST_GAIN = 1e-3
#: Of the tied words: most with a symbol of their own, classes of the others.
SYMBOLS, CLASSES = 8192, 16
#: Tokens whose recursions are held at once, and tokens of a piece of a text: pieces run side
#: by side, so a long text costs no more steps than a short one.
BATCH_TOKENS, SPAN = 250_000, 256
#: Bytes of text in a block: a round moves four numbers per distinct word of a block.
BLOCK_BYTES = 32_000_000
#: Bytes of text to a bucket at least: a round starts a task per bucket, and with less text
#: the start takes longer than the work.
LEAST_BUCKET = 1_000_000


def words() -> object:
    return lambda text: text.lower().split()


def length_class(word: bytes) -> int:
    return min(len(word), CLASSES) - 1


@dataclass
class Vocabulary:
    """Counts of the training tokens; ``symbol`` numbers the frequent words, after them
    come the classes and the end token."""

    tokens: int
    types: int
    texts: int
    symbol: dict[bytes, int]
    counts: list[int]
    class_tokens: list[int]
    class_types: list[int]

    @property
    def size(self) -> int:
        return len(self.symbol) + CLASSES + 1

    @property
    def end(self) -> int:
        return self.size - 1

    def unigram(self) -> np.ndarray:
        n = np.array([*self.counts, *self.class_tokens, self.texts], float) + 1
        return n / n.sum()


@dataclass
class Model:
    start: np.ndarray
    moves: np.ndarray
    emits: np.ndarray  # a row per symbol, a column per state


def input_rows(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       (~held_out).alias("flag"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def _totals(lists, arrays) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    distinct, places = blocks.distinct(lists)
    total = np.zeros(len(distinct), np.int64)
    for p, (count,) in zip(places, arrays):
        total[p] += count
    return distinct, places, total


def vocabulary(table: DataFrame, docs: DataFrame, most: int = SYMBOLS) -> Vocabulary:
    def run(t: pa.Table) -> pa.Table:
        lists = [blocks.unpack_words(x) for x in t.column("payload").to_pylist()]
        found, _, total = _totals([w for w, _ in lists], [a for _, a in lists])
        known = np.flatnonzero(total)
        return pa.table({"word": pa.array([found[i] for i in known], pa.binary()),
                         "n": pa.array(total[known], pa.int64())})

    stored = store(table.where("bucket >= 0").select("bucket", "payload").groupBy(
        "bucket").applyInArrow(run, "word binary, n long"), "word-counts")
    counts = stored.df
    texts = docs.where("flag").count()
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens = row["n"] + texts
    # At most `most` words hold 1/most of the tokens each.
    frequent = counts.where(F.col("n") * most >= tokens)
    kept = sorted((-r["n"], bytes(r["word"])) for r in frequent.collect())
    in_class = counts.where(F.col("n") * most < tokens).groupBy(
        F.least(F.octet_length("word"), F.lit(CLASSES)).alias("c")).agg(
        F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    class_tokens, class_types = [0] * CLASSES, [0] * CLASSES
    for r in in_class:
        class_tokens[r["c"] - 1], class_types[r["c"] - 1] = r["n"], r["v"]
    stored.drop()
    return Vocabulary(tokens, row["v"] + (texts > 0), texts, {w: i for i, (_, w) in enumerate(kept)},
                      [-n for n, _ in kept], class_tokens, class_types)


def _symbols(voc: Vocabulary, found: list[bytes]) -> np.ndarray:
    first = len(voc.symbol)
    return np.fromiter((voc.symbol.get(w, first + length_class(w)) for w in found),
                       np.int64, len(found))


_SEQUENCES = "flag boolean, payload binary"


def sequences(table: DataFrame, v: Vocabulary) -> Stored:
    """The symbols of each training document (with the end token)."""
    sent = table.sparkSession.sparkContext.broadcast(v)  # SYMBOLS words at most

    def answer(lists, arrays):
        found, places = blocks.distinct(lists)
        symbol = _symbols(sent.value, found)
        return [blocks.pack(symbol[p]) for p in places]

    def finish(docs: blocks.Documents, answers: blocks.Answers) -> pa.Table:
        symbol, end = answers.values(0), sent.value.end
        payloads = [blocks.pack(np.append(symbol[at], end))
                    for flag, at in zip(docs.flags, docs.tokens) if flag]
        return pa.table({"flag": pa.array([True] * len(payloads), pa.bool_()),
                         "payload": pa.array(payloads, pa.binary())})

    return store(blocks.finished(table, blocks.answered(table, answer), finish, _SEQUENCES),
                 "sequences")


def initial(v: Vocabulary, states: int = STATES, seed: int = 7) -> Model:
    """Near the unigram, with a fixed disturbance so that the states can part."""
    noise = np.random.default_rng(seed)
    emits = v.unigram()[:, None] * noise.uniform(0.5, 1.5, (v.size, states))
    moves = noise.uniform(0.5, 1.5, (states, states))
    return Model(np.full(states, 1 / states), moves / moves.sum(1, keepdims=True),
                 emits / emits.sum(0))


@dataclass
class Pieces:
    """Texts cut into pieces of at most ``SPAN`` tokens: all tokens in a row, and of each
    piece its text, its number in the text, where it starts and its size."""

    flat: np.ndarray
    text: np.ndarray
    nth: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> Pieces:
        lengths = np.array([len(t) for t in texts])
        n = -(-lengths // SPAN)
        text = np.repeat(np.arange(len(texts)), n)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
        start = (np.cumsum(lengths) - lengths)[text] + nth * SPAN
        flat = np.concatenate(texts).astype(np.intp)
        return cls(flat, text, nth, start, np.minimum(SPAN, lengths[text] - nth * SPAN))

    def chunks(self, which: np.ndarray) -> Iterator[np.ndarray]:
        """Pieces in lists of bounded size, the longest ones first."""
        which = which[np.argsort(-self.size[which], kind="stable")]
        cut = np.flatnonzero(np.diff(np.cumsum(self.size[which]) // BATCH_TOKENS)) + 1
        return (x for x in np.split(which, cut) if len(x))

    def steps(self, chunk: np.ndarray, m: Model):
        """For each step, how many pieces of the chunk still run, their symbols and
        emissions (a row per state)."""
        start, size = self.start[chunk], self.size[chunk]
        for t, n in enumerate(np.searchsorted(-size, -np.arange(size[0]), "left").tolist()):
            s = self.flat.take(start[:n] + t)
            yield n, s, np.ascontiguousarray(m.emits.take(s, 0).T)


def _edges(m: Model, p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Of each piece, the probabilities of its first state given all before it, and (scaled)
    of all behind it given its last state.

    What a piece does to any probabilities that enter it is a matrix; the matrices of all
    pieces are worked out side by side, and only they are gone through in a row.
    """
    states = len(m.start)
    enter = np.repeat(m.start[:, None], len(p.nth), 1)
    leave = np.ones((states, len(p.nth)))
    inner = np.flatnonzero(p.nth > 0)
    several = np.union1d(inner, inner - 1)
    if not len(several):
        return enter, leave
    moves, through = np.ascontiguousarray(m.moves.T), np.empty((states, states, len(p.nth)))
    for chunk in p.chunks(several):
        now = np.zeros((states, states, len(chunk)))
        for t, (n, _, e) in enumerate(p.steps(chunk, m)):
            if t == 0:
                now[np.arange(states), np.arange(states)] = e
            else:
                after = (moves @ now[:, :, :n].reshape(states, -1)).reshape(states, states, n)
                after *= e[:, None]
                now[:, :, :n] = after / after.sum((0, 1))
        through[:, :, chunk] = now
    order = inner[np.argsort(p.nth[inner], kind="stable")]
    ranks = np.split(order, np.flatnonzero(np.diff(p.nth[order])) + 1)
    for at in ranks:
        a = np.einsum("ijn,jn->in", through[:, :, at - 1], enter[:, at - 1])
        enter[:, at] = moves @ (a / a.sum(0))
    for at in reversed(ranks):
        b = m.moves @ np.einsum("ijn,in->jn", through[:, :, at], leave[:, at])
        leave[:, at - 1] = b / b.sum(0)
    return enter, leave


def _forward(m: Model, p: Pieces, chunk: np.ndarray, enter: np.ndarray):
    """Per step of a chunk: symbols, emissions, scaled forward values and scales."""
    moves, a = np.ascontiguousarray(m.moves.T), None
    for n, s, e in p.steps(chunk, m):
        a = (enter[:, chunk] if a is None else moves @ a[:, :n]) * e
        scale = a.sum(0)
        a /= scale
        yield s, e, a, scale


def likelihood(m: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log likelihood of each symbol sequence, by the scaled forward recursion."""
    p, total = Pieces.of(texts), np.zeros(len(texts))
    enter, _ = _edges(m, p)
    for chunk in p.chunks(np.arange(len(p.nth))):
        of_piece = np.zeros(len(chunk))
        for _, _, _, scale in _forward(m, p, chunk, enter):
            of_piece[: len(scale)] += np.log(scale)
        total += np.bincount(p.text[chunk], of_piece, len(texts))
    return total


def expected(m: Model, texts: list[np.ndarray], symbols: int):
    """Expected counts of starts, moves and emissions, and the log likelihood."""
    p = Pieces.of(texts)
    enter, leave = _edges(m, p)
    states, loglik = len(m.start), 0.0
    start, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states))
    first, last = np.empty_like(enter), np.empty_like(enter)
    for chunk in p.chunks(np.arange(len(p.nth))):
        held = list(_forward(m, p, chunk, enter))
        ends = np.empty((states, len(chunk)))
        for _, _, a, scale in held:
            loglik += float(np.log(scale).sum())
            ends[:, : a.shape[1]] = a
        behind = leave[:, chunk]
        behind = behind / (ends * behind).sum(0)
        weights, after = [None] * len(held), None
        for t in range(len(held) - 1, -1, -1):
            _, e, a, scale = held[t]
            b = behind[:, : a.shape[1]].copy()
            if after is not None:
                n = after.shape[1]
                moves += a[:, :n] @ after.T
                b[:, :n] = m.moves @ after
            weights[t], after = a * b, e * b / scale
        start += weights[0][:, p.nth[chunk] == 0].sum(1)
        first[:, chunk], last[:, chunk] = after, ends
        every, weight = np.concatenate([x[0] for x in held]), np.concatenate(weights, 1)
        for j in range(states):
            emits[:, j] += np.bincount(every, weight[j], symbols)
    inner = np.flatnonzero(p.nth > 0)
    moves += last[:, inner - 1] @ first[:, inner].T
    return start, moves * m.moves, emits, loglik


def _grouped(texts: Iterable[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Lists of texts of bounded size (or one text)."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > BATCH_TOKENS:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


#: Rows of the counts that are no symbols: starts, log likelihood, moves from state 0 on.
_START, _LOGLIK, _MOVES = -1, -2, -3


def _rounds(v: Vocabulary, most: int | None) -> Iterator[Callable[[float], None]]:
    """Goes on until the log likelihoods told to it gain less than LEAST_GAIN per token,
    or for ``most`` rounds."""
    told: list[float] = []
    while most is None or len(told) < most:
        yield told.append
        if len(told) > 1 and told[-1] - told[-2] < LEAST_GAIN * v.tokens:
            return


def learned(seqs: DataFrame, v: Vocabulary, states: int = STATES, rounds: int | None = None) -> Model:
    """Baum-Welch over all training sequences of tied words, at most ``rounds`` times."""
    m, sc = initial(v, states), seqs.sparkSession.sparkContext
    columns = [f"s{k}" for k in range(states)]
    training = seqs.where("flag").select("payload")
    prior = v.unigram()
    for tell in _rounds(v, rounds):
        sent = sc.broadcast((m, v.size))

        def run(batches: Batches) -> Batches:
            now, size = sent.value
            start, moves, emits, loglik = 0.0, 0.0, 0.0, 0.0
            payloads = (x for batch in batches for x in batch.column("payload").to_pylist())
            for held in _grouped(blocks.unpack(x)[0] for x in payloads):
                s, mv, e, ll = expected(now, held, size)
                start, moves, emits, loglik = start + s, moves + mv, emits + e, loglik + ll
            if np.ndim(start):
                keys = np.concatenate([[_START, _LOGLIK], _MOVES - np.arange(states),
                                       np.arange(size)])
                body = np.concatenate([[start], [np.full(states, loglik)], moves, emits])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int32))] + [pa.array(body[:, k]) for k in range(states)],
                    ["symbol", *columns])

        sums = in_arrow(training, lambda run=run: run,
                        "symbol int, " + ", ".join(f"{c} double" for c in columns))
        rows = sums.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns]).collect()
        if not rows:
            return m
        got = {r["symbol"]: np.array([r[c] for c in columns]) for r in rows}  # symbols + states + 2
        tell(got[_LOGLIK][0])
        moves = np.stack([got[_MOVES - k] for k in range(states)]) + 0.1
        emits = np.stack([got[i] for i in range(v.size)]) + prior[:, None] * v.size
        start = got[_START] + 0.1
        m = Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    return m


@dataclass
class Words:
    """A model with emissions for every training word: ``rows`` hold, per block and bucket,
    the training counts, places and classes (from 1; 0: frequent) of the block's words, and
    their emissions; they are worked out from the table ``source``."""

    start: np.ndarray
    moves: np.ndarray
    end: np.ndarray  # emission of the end token
    rows: DataFrame
    source: Stored


_ROWS = "block string, bucket int, payload binary, emits binary"
_COUNTS = "block string, bucket int, payload binary, counts binary, stats array<double>"


def _cells(data: bytes, states: int) -> np.ndarray:
    return np.frombuffer(data, "<f4").reshape(-1, states)


def untied(table: DataFrame, v: Vocabulary, m: Model) -> Words:
    """The model of tied words as one in which every word stands alone."""
    sent = table.sparkSession.sparkContext.broadcast((v, m))

    def run(t: pa.Table) -> pa.Table:
        voc, tied = sent.value
        lists = [blocks.unpack_words(x) for x in t.column("payload").to_pylist()]
        found, places, total = _totals([w for w, _ in lists], [a for _, a in lists])
        symbol = _symbols(voc, found)
        of_class = symbol - len(voc.symbol)
        room = np.array(voc.class_tokens) + np.array(voc.class_types) + 1
        share = np.where(of_class >= 0, (total + 1) / room[np.maximum(of_class, 0)], 1.0)
        emits = (tied.emits[symbol] * share[:, None]).astype("<f4")
        kind = np.maximum(of_class + 1, 0)
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"),
                         "payload": pa.array([blocks.pack(total[p], p, kind[p]) for p in places], pa.binary()),
                         "emits": pa.array([emits[p].tobytes() for p in places], pa.binary())})

    rows = store(table.where("bucket >= 0").groupBy("bucket").applyInArrow(run, _ROWS), "words")
    return Words(m.start, m.moves, m.emits[v.end], rows.df, rows)


def _local(docs: blocks.Documents, right: pa.Table, start, moves, end) -> Model:
    """The model with the emissions of a block's own words, by number, and the end token."""
    emits = np.empty((len(docs.buckets) + 1, len(start)))
    numbers = blocks.Answers(docs.buckets, {}).numbers
    for b, data in zip(right.column("bucket").to_pylist(), right.column("emits").to_pylist()):
        emits[numbers[b]] = _cells(data, len(start))
    emits[-1] = end
    return Model(start, moves, emits)


def _answers(docs: blocks.Documents, right: pa.Table) -> blocks.Answers:
    parts = zip(right.column("bucket").to_pylist(), right.column("payload").to_pylist())
    return blocks.Answers(docs.buckets, {b: blocks.unpack(x) for b, x in parts})


def tasks(table: DataFrame) -> int:
    """Tasks for all blocks: partitions may be far more than blocks, and those without one
    take as long to start and to write."""
    return max(1, 2 * table.where("bucket < 0").count())


def counted(docs: DataFrame, words: Words, most: int) -> Stored:
    """Expected counts of the training documents, in ``most`` tasks at most: a row per block
    and bucket, and one with the sums of the block: log likelihood, starts, moves, ends, and
    tokens of frequent words and of each class."""
    states = len(words.start)
    sent = docs.sparkSession.sparkContext.broadcast((words.start, words.moves, words.end))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        held = blocks.Documents.unpacked(left.column("payload")[0].as_py())
        m, size = _local(held, right, *sent.value), len(held.buckets) + 1
        kind = _answers(held, right).values(2)
        start, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros((size, states))
        loglik = 0.0
        texts = (np.append(t, size - 1) for t, flag in zip(held.tokens, held.flags) if flag)
        for group in _grouped(texts):
            s, mv, e, ll = expected(m, group, size)
            start, moves, emits, loglik = start + s, moves + mv, emits + e, loglik + ll
        classes = np.stack([np.bincount(kind, e, CLASSES + 1) for e in emits[:-1].T], 1)
        stats = [loglik, *start, *moves.ravel(), *emits[-1], *classes.ravel()]
        numbers, name = blocks.Answers(held.buckets, {}).numbers, left.column("block")[0].as_py()
        buckets = right.column("bucket").to_pylist()
        counts = [emits[numbers[b]].astype("<f4").tobytes() for b in buckets]
        return pa.table({
            "block": pa.array([name] * (len(buckets) + 1)), "bucket": pa.array([*buckets, -1], pa.int32()),
            "payload": pa.array([*right.column("payload").to_pylist(), None], pa.binary()),
            "counts": pa.array([*counts, None], pa.binary()),
            "stats": pa.array([None] * len(buckets) + [stats], pa.list_(pa.float64()))})

    found = docs.groupBy("block").cogroup(words.rows.groupBy("block")).applyInArrow(run, _COUNTS)
    return store(found.coalesce(most), "expected")


def raised(stored: Stored, v: Vocabulary, states: int) -> tuple[Words, float]:
    """The model of the expected counts, and the log likelihood of the one before.

    Frequent words and classes are smoothed by their training counts as tied ones are.  In
    its class a word counts once more, in a state by the state's part of the class, and a
    state has as many more tokens as the class has words, dealt by their training counts:
    so a word never counted has the same probability in its class in every state.
    """
    counts = stored.df
    cuts = np.cumsum([1, states, states**2, states, (CLASSES + 1) * states])
    got = np.array(counts.where("bucket < 0").agg(
        *[F.sum(F.col("stats")[i]) for i in range(int(cuts[-1]))]).first())
    loglik, start, moves, end, of = np.split(got, cuts[:-1])
    of = of.reshape(CLASSES + 1, states)
    norm = of.sum(0) + end + v.size
    unigram = v.unigram()
    held, types = np.array(v.class_tokens), np.array(v.class_types)
    room, more = held + types + 1, types + 1
    tied = (of[1:] + v.size * unigram[len(v.symbol) : -1, None]) / norm
    part = of[1:] / np.maximum(held, 1)[:, None]
    size, all_tokens = v.size, v.tokens + v.size

    def run(t: pa.Table) -> pa.Table:
        parts = [blocks.unpack(x) for x in t.column("payload").to_pylist()]
        n = max(int(p.max()) for _, p, _ in parts) + 1
        total, kind, emits = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, states))
        for (count, p, k), data in zip(parts, t.column("counts").to_pylist()):
            total[p], kind[p] = count, k
            emits[p] += _cells(data, states)
        own, c, known = (total + 1)[:, None], np.maximum(kind - 1, 0), more[:, None]
        rare = tied[c] * (emits + part[c] + known[c] * own / room[c, None]) / (part * room[:, None] + known)[c]
        emits = np.where(kind[:, None] > 0, rare, (emits + size * own / all_tokens) / norm).astype("<f4")
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"),
                         "payload": t.column("payload"),
                         "emits": pa.array([emits[p].tobytes() for _, p, _ in parts], pa.binary())})

    rows = counts.where("bucket >= 0").drop("stats").groupBy("bucket").applyInArrow(run, _ROWS)
    start, moves = start + 0.1, moves.reshape(states, states) + 0.1
    return Words(start / start.sum(), moves / moves.sum(1, keepdims=True),
                 (end + size * unigram[-1]) / norm, rows, stored), float(loglik[0])


def trained(table: DataFrame, docs: DataFrame, v: Vocabulary, m: Model,
            rounds: int | None = None) -> Words:
    """Baum-Welch with every training word alone, from the model of tied words.  The table
    of a round goes once that of the next is written."""
    words, most = untied(table, v, m), tasks(table)
    for tell in _rounds(v, rounds if v.texts else 0):
        before, counts = words.source, counted(docs, words, most)
        words, loglik = raised(counts, v, len(m.start))
        before.drop()
        tell(loglik)
    return words


_SCORES = ("doc_id long, flag boolean, n_tokens long, n_known long, base_score double, "
           "score double")


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
           states: int = STATES, rounds: int | None = None) -> DataFrame:
    """Learns from the documents where ``held_out`` is false and scores all: doc_id,
    held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    rows = input_rows(docs, held_out, id_col, text_col)
    cut = blocks.stored(rows, words, counted=True, size=BLOCK_BYTES, least=LEAST_BUCKET)
    table = cut.df
    v = vocabulary(table, rows)
    seqs = sequences(table, v)
    tied = learned(seqs.df, v, states, rounds)
    seqs.drop()
    # The documents lie where the emissions of every round come to them.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = table.where("bucket < 0").select("block", "payload").repartition(n, "block").persist(
        StorageLevel.DISK_ONLY)
    model = trained(table, held, v, tied, rounds)
    sent = docs.sparkSession.sparkContext.broadcast((model.start, model.moves, model.end))
    whole, texts, tokens = v.tokens + v.types + 1, v.texts, v.tokens

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block = blocks.Documents.unpacked(left.column("payload")[0].as_py())
        m, end = _local(block, right, *sent.value), len(block.buckets)
        count = _answers(block, right).values(0)
        base, end_score = np.log10((count + 1) / whole), np.log10((texts + 1) / whole)
        score = [likelihood(m, group) / np.log(10)
                 for group in _grouped(np.append(t, end) for t in block.tokens)]
        columns = [
            block.ids, block.flags, [len(t) + 1 for t in block.tokens],
            [int((count[t] > 0).sum()) + (texts > 0) for t in block.tokens],
            [float(base[t].sum() + end_score) for t in block.tokens], np.concatenate(score)]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({c.split()[0]: pa.array(x, k)
                         for c, x, k in zip(_SCORES.split(", "), columns, kinds)})

    found = held.groupBy("block").cogroup(model.rows.groupBy("block")).applyInArrow(run, _SCORES)
    scored = materialize(found.coalesce(tasks(table)), "scores")
    held.unpersist()
    for used in (cut, model.source):
        used.drop()
    return scored.select(
        "doc_id", (~F.col("flag")).alias("held_out"), "n_tokens", "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
