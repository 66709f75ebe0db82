"""Exact similarity join of documents on word shingles, by universe partition.

Two sets of a and b shingles have a Jaccard similarity of 0.8 or more only if they
differ in at most H = (a + b) / 9 shingles.  Shingles are hashed into segments, the same
way for all sets of a size band (sizes up to a power of two) and for the smaller sets
that reach into it.  If a set picks segments worth H + 1 units, where a segment is worth
one unit if compared as it is and two if compared up to one deletion, then by the
pigeonhole principle a similar set agrees with it on one of them.

* Index: every set files the segments it has something in (those that some smaller set
  may pick, see ``Band.reach``), and for every 32nd segment its one-deletion
  neighbourhood too.
* Probe: every set picks units by cost in its own band, and in the next one if similar
  sets may lie there.  The cost of a unit is the number of sets nearby that share the
  segment and the rows it sends, so what many documents quote is passed over and
  one-deletion units take its place.
* A set whose segments aren't worth enough (chance only) probes again with other hashes.

Sets that share a filed segment are candidates.  A bucket is not expanded into all pairs:
its probes are first compared with one member, the most central; what turns out linked
forms components, and only members of different components are then compared, by parity sketches that bound
their differences from below.  Candidates are verified on the texts, word by word.

Sets are told apart by a 64-bit hash of their shingles' hashes, and their size.

Cases: null, empty and wordless texts have no shingle and are linked with nothing; fewer
words than a shingle make one shingle; repeated rows and equal sets are copies of one
set; a document without id is linked only as a copy; very long texts are read whole; an
empty table gives an empty result; further columns are left aside (``similar``) or kept
(``one_of_each``), also where their names are used here.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spoor.llm.common import Batches, in_arrow, texts, window_codes
from spoor.llm.components import components
from spoor.session import materialize

# Words in a shingle; links need 100 * intersection >= 80 * union.
WORDS, PERCENT = 5, 80

U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)

#: Shingles handled at once, and every which segment holds one-deletion neighbourhoods.
CHUNK, DELETION_EVERY = 250_000, 32
#: Most ids that are sent to all executors, so that the texts stay where they are.
SENT_IDS = 2_000_000
#: Roles of an entry; TWICE: a probe whose segment is compared up to one deletion as well.
DOCUMENT, INDEX, PROBE, SHORT, TWICE = 0, 1, 2, 4, 8


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


def shingles(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles."""
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    k = min(WORDS, len(words))
    n = len(words) - k + 1
    x = np.full(n, U(k))
    for i in range(k):
        x = mixed(x * _STEP + h[i : i + n])
    return np.unique(x)


def differences(a: int, b: int) -> int:
    """Most shingles in which linked sets of these sizes differ."""
    return (a + b) * (100 - PERCENT) // (100 + PERCENT)


class Band:
    """Sets of 2 ** (number - 1) to 2 ** number - 1 shingles (the first band: all below)."""

    FIRST = 5

    def __init__(self, number: int):
        self.number, self.top = number, (1 << number) - 1
        self.least = 0 if number == self.FIRST else 1 << (number - 1)
        # Segments: as many as the largest sets need units, and some for those left empty;
        # in the first band every shingle is a segment of its own.
        self.segments = 0 if number == self.FIRST else int(
            np.ceil(0.25 * (self.top + 1) + 1.2 * np.sqrt(self.top + 1)))

    def units(self, size: int) -> int:
        """What a probe of this size needs against sets of its size or larger in the band."""
        return differences(size, min(self.top, size * 100 // PERCENT)) + 1

    def reach(self, sizes: np.ndarray) -> np.ndarray:
        """Probes of these sizes pick among so many first segments, and sets of this size or
        larger file at least these (it never falls with the size): enough for the units,
        with room for choice and chance."""
        if not self.segments:
            return np.zeros(len(sizes), np.int64)
        sizes = np.maximum(sizes, self.least)
        units = (sizes + np.minimum(self.top, sizes * 100 / PERCENT)) / 9 + 1
        need = 1.08 * units + 1.5 * np.sqrt(units) + 2
        filled = 1 - np.exp(-sizes / self.segments)
        return np.minimum(self.segments, np.ceil(need / filled)).astype(np.int64)


@lru_cache(maxsize=64)
def band(number: int) -> Band:
    return Band(number)


def band_of(size: int) -> int:
    return max(Band.FIRST, int(size).bit_length())


def keys(body: np.ndarray, number: int, segment: np.ndarray, kind: int) -> np.ndarray:
    """Keys of segment contents (``body``: sum of the mixed hashes), 0 = as filed,
    1 = one element short."""
    return mixed(body + segment.astype(U) * _STEP + U((number * 2 + kind) * 0x632BE59BD9B4E019 % 2**64))


class Segments:
    """The segments of some sets in one band."""

    def __init__(self, sets: list[np.ndarray], number: int, seed: int, upto: np.ndarray):
        b = band(number)
        sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), sizes)
        x = np.concatenate(sets) if sets else np.empty(0, U)
        if b.segments:
            spread = mixed(x + U((number * 1_000_003 + seed * 7919) % 2**64)) >> U(32)
            g = ((spread * U(b.segments)) >> U(32)).astype(np.int64)
            kept = g < upto[owner]
            x, owner, g = x[kept], owner[kept], g[kept]
            order = np.argsort(owner * b.segments + g, kind="stable")
            x, owner, g = mixed(x[order]), owner[order], g[order]
            new = np.ones(len(x), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (g[1:] != g[:-1])
            first = np.flatnonzero(new)
        else:
            first, g, x = np.arange(len(x)), np.zeros(len(x), np.int64), mixed(x)
        self.number, self.elements, self.first = number, x, first
        self.count = np.diff(np.append(first, len(x)))
        self.owner, self.segment = owner[first], g[first]
        self.body = np.add.reduceat(x, first) if len(first) else np.empty(0, U)
        self.exact = keys(self.body, number, self.segment, 0)
        # Segments compared up to one deletion must keep an element without it.
        self.double = (self.segment % DELETION_EVERY == 0) & (self.count > 1) & bool(b.segments)

    def deletions(self, which: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the segments ``which`` less one element each, and their owners."""
        n = self.count[which]
        at = np.repeat(self.first[which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        of = np.repeat(which, n)
        return keys(self.body[of] - self.elements[at], self.number, self.segment[of], kind), self.owner[of]


def picked(s: Segments, need: np.ndarray, common: tuple[np.ndarray, np.ndarray], sent: int):
    """Which segments are compared as they are and which up to one deletion, by least cost,
    and which sets don't reach the units they need.

    A segment offers its first unit at the number of sets nearby that share it, its second
    (one-deletion) for that and the rows its neighbourhood sends.
    """
    at = np.searchsorted(common[0], s.exact)
    at[at == len(common[0])] = 0
    shared = np.where(common[0][at] == s.exact, common[1][at], 0) if len(common[0]) else 0 * at
    upgrade = np.flatnonzero(s.double)
    cost = np.concatenate([shared + sent, shared[upgrade] + s.count[upgrade] + 1 + sent])
    second = np.concatenate([np.zeros(len(shared), bool), np.ones(len(upgrade), bool)])
    which = np.concatenate([np.arange(len(shared)), upgrade])
    owner = s.owner[which]
    order = np.lexsort((second, cost, owner))
    sorted_owner = owner[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_owner, sorted_owner, "left")
    chosen = order[rank < need[sorted_owner]]
    offered = np.bincount(owner, minlength=len(need))
    return which[chosen[~second[chosen]]], which[chosen[second[chosen]]], offered < need


def entries(sets: list[np.ndarray], seed: int, probing: np.ndarray):
    """(key, set, role) of all entries of some sets of at least 4 shingles; ``probing``
    says which of them probe."""
    sizes = np.array([len(s) for s in sets], np.int64)
    numbers = np.array([band_of(n) for n in sizes])
    over = (sizes * 100 // PERCENT) >= (1 << numbers)  # similar sets may be in the next band
    out: list[tuple[np.ndarray, np.ndarray, int]] = []
    short = np.zeros(len(sets), bool)

    def probe(s: Segments, members: np.ndarray, need: np.ndarray, common, own: bool) -> None:
        exact, double, lacking = picked(s, need, common, 0 if own else 1)
        short[members[lacking]] = True
        role = np.full(len(s.exact), INDEX if own else 0)
        role[exact] |= PROBE
        role[double] |= TWICE
        used = np.flatnonzero(role)
        for r in np.unique(role[used]):
            part = used[role[used] == r]
            out.append((s.exact[part], members[s.owner[part]], int(r)))
        out.append((keys(s.body[double], s.number, s.segment[double], 1),
                    members[s.owner[double]], PROBE))
        k, owner = s.deletions(double, 0)
        out.append((k, members[owner], PROBE))

    for number in np.unique(np.concatenate([numbers, numbers[over] + 1])):
        b = band(int(number))
        own = np.flatnonzero(numbers == number)
        s = Segments([sets[i] for i in own], int(number), seed, b.reach(sizes[own]))
        common = np.unique(s.exact, return_counts=True)
        common = (common[0], common[1] - 1)
        need = np.where(probing[own], [b.units(int(n)) for n in sizes[own]], 0)
        probe(s, own, need, common, True)
        k, owner = s.deletions(np.flatnonzero(s.double), 1)
        out.append((k, own[owner], INDEX))
        below = np.flatnonzero((numbers == number - 1) & over & probing)
        if len(below):
            lowest = b.reach(np.full(len(below), b.least))
            s = Segments([sets[i] for i in below], int(number), seed, lowest)
            more = (common[0], common[1] + 1)
            probe(s, below, np.array([b.units(int(n)) for n in sizes[below]]), more, False)
    return out, short


_ROWS = "key long, id long, role int, size int, doc_id long, text_hash long, parity array<long>"

#: Longs of a set's parity sketch.
LONGS = 16


def parity(s: np.ndarray) -> np.ndarray:
    """Which of 64 * LONGS slots hold an odd number of the set's shingles.  Two sets differ in
    at least as many shingles as slots: a shingle of both changes none."""
    slots = (mixed(s ^ _STEP) >> U(32)).astype(np.int64) % (64 * LONGS)
    odd = (np.bincount(slots, minlength=64 * LONGS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def _apart(x: str, y: str) -> Column:
    """Differences that the sketches of two sets (arrays) show."""
    return sum((F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(LONGS)), F.lit(0))


def _allowed(x, y) -> Column:
    """Differences that linked sets of these sizes may have."""
    return F.floor((x + y) * (100 - PERCENT) / (100 + PERCENT))


def set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _emit(sets: dict[int, np.ndarray], seed: int):
    ids = np.array([i for i in sets], np.int64)
    bodies = list(sets.values())
    probing = np.ones(len(bodies), bool)
    for earlier in range(seed):  # probes again where all earlier hashes fell short
        probing &= entries(bodies, earlier, probing)[1]
    out, short = entries(bodies, seed, probing)
    key = np.concatenate([k for k, _, _ in out])
    owner = np.concatenate([o for _, o, _ in out])
    role = np.repeat([r for _, _, r in out], [len(k) for k, _, _ in out])
    lacking = np.flatnonzero(short & probing)
    key = np.concatenate([key.view(np.int64), ids[lacking]])
    owner = np.concatenate([owner, lacking])
    role = np.concatenate([role, np.full(len(lacking), SHORT)])
    n = len(key)
    nothing = pa.nulls(n, pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(ids[owner]), pa.array(role.astype(np.int32)),
         pa.nulls(n, pa.int32()), nothing, nothing, pa.nulls(n, pa.list_(pa.int64()))],
        [c.split()[0] for c in _ROWS.split(", ")])


def _sets(seed: int):
    """A row per document (with the first seed) and the entries of its set; copies in a
    task's run of documents file once."""

    def run(batches: Batches) -> Batches:
        hashes = WordHashes()
        for batch in batches:
            held: dict[int, np.ndarray] = {}
            size = 0
            ids, sizes, odd = [], [], []
            for text in texts(batch, "text"):
                s = shingles(text.lower().split(), hashes)
                ids.append(set_id(s))
                sizes.append(len(s))
                if seed == 0:
                    odd.append(parity(s))
                if len(s) > 3 and ids[-1] not in held:  # smaller sets link to copies only
                    held[ids[-1]] = s
                    size += len(s)
                if size >= CHUNK:
                    yield from _emit(held, seed)
                    held, size = {}, 0
            if held:
                yield from _emit(held, seed)
            if seed == 0:
                doc_ids, hashed = batch.column("doc_id"), batch.column("text_hash")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("spread"), pa.array(ids, pa.int64()),
                     pa.array(np.full(len(ids), DOCUMENT, np.int32)), pa.array(sizes, pa.int32()),
                     doc_ids, hashed, pa.array(odd, pa.list_(pa.int64()))], [c.split()[0] for c in _ROWS.split(", ")])

    return run


def _shared(docs: DataFrame, seed: int) -> DataFrame:
    """Document rows, and the entries of buckets that hold a probe and another set, with
    how many filed a set there (``shared_by``)."""
    rows = in_arrow(docs, lambda: _sets(seed), _ROWS)
    w = Window.partitionBy("key")
    entry = F.when(~F.col("role").isin(DOCUMENT, SHORT), F.col("id"))
    filed = F.when(F.col("role").bitwiseAND(INDEX) > 0, F.col("id"))
    rows = rows.select(
        "*", F.count(filed).over(w).alias("shared_by"), F.min(entry).over(w).alias("low"),
        F.max(entry).over(w).alias("high"),
        F.max(F.col("role").bitwiseAND(PROBE)).over(w).alias("probed"))
    kept = F.col("role").isin(DOCUMENT, SHORT) | (
        (F.col("low") != F.col("high")) & (F.col("probed") > 0) & (F.col("shared_by") > 0))
    return materialize(_once(rows.where(kept).drop("low", "high", "probed")), "shared-segments")


def _once(rows: DataFrame) -> DataFrame:
    """One entry per bucket and set, with the roles of all: copies that several tasks filed
    would meet in a bucket as often as their numbers multiplied.  A set then probes all units
    that any of its copies picked."""
    every = F.col("role").isin(DOCUMENT, SHORT)
    of_set = Window.partitionBy("key", "id").orderBy(every, "role")
    whole = of_set.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select("*", F.row_number().over(of_set).alias("nth"),
                       F.bit_or(F.when(~every, F.col("role"))).over(whole).alias("roles"))
    return rows.where(every | (F.col("nth") == 1)).withColumn(
        "role", F.when(every, F.col("role")).otherwise(F.col("roles"))).drop("nth", "roles")


def linked(a: bytes, b: bytes) -> bool:
    """Whether two texts link, on their words themselves."""
    number: dict[bytes, int] = {}
    first, second = a.lower().split(), b.lower().split()
    if min(len(first), len(second)) < WORDS:
        return bool(first) and first == second
    ids = np.fromiter((number.setdefault(w, len(number)) for w in first + second), np.int64,
                      len(first) + len(second))
    code = window_codes(ids, WORDS)
    x = np.unique(code[: len(first) - WORDS + 1])
    y = np.unique(code[len(first):])
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= PERCENT * (len(x) + len(y) - common)


def _verify(batches: Batches) -> Batches:
    for batch in batches:
        ok = [linked(x, y) for x, y in zip(texts(batch, "text_a"), texts(batch, "text_b"))]
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _sieve(hashed: DataFrame, bits: int = 1 << 20) -> Column:
    """A condition that holds for all ``hashed(text_hash)``, and few others if these are
    few: a bitmap of fixed size."""
    slots = hashed.select(F.pmod("text_hash", F.lit(bits)).alias("slot")).distinct().collect()
    bitmap = np.zeros(bits, np.uint8)
    bitmap[[r["slot"] for r in slots]] = 1  # at most `bits` numbers
    longs = np.packbits(bitmap, bitorder="little").view("<i8")
    cells = F.split(F.lit(",".join(map(str, longs.tolist()))), ",").cast("array<bigint>")
    slot = F.pmod("text_hash", F.lit(bits))
    return F.getbit(F.element_at(cells, (F.shiftright(slot, 6) + 1).cast("int")),
                    slot.bitwiseAND(63).cast("int")) == 1


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids that link, checked on one text of each set."""
    def side(name):
        return classes.select(F.col("id").alias(name), F.col("size").alias(f"size_{name}"),
                              F.col("doc_id").alias(f"doc_{name}"),
                              F.col("parity").alias(f"parity_{name}"),
                              F.col("text_hash").alias(f"text_hash_{name}"))

    known = pairs.join(side("a"), "a").join(side("b"), "b").where(
        _apart("parity_a", "parity_b") <= _allowed(F.col("size_a"), F.col("size_b")))
    known = materialize(known.select("a", "b", "doc_a", "doc_b", "text_hash_a", "text_hash_b"),
                        "candidates")
    hashed = known.select(F.explode(F.array("text_hash_a", "text_hash_b")).alias("text_hash"))
    held = docs.select("doc_id", "text_hash", "text").where(_sieve(hashed))

    def text(name):
        return held.select(F.col("doc_id").alias(f"doc_{name}"),
                           F.col("text_hash").alias(f"text_hash_{name}"),
                           F.col("text").alias(f"text_{name}"))

    joined = known.join(text("a"), ["doc_a", "text_hash_a"]).join(text("b"), ["doc_b", "text_hash_b"])
    return materialize(in_arrow(joined.select("a", "b", "text_a", "text_b"), lambda: _verify,
                                "a long, b long").distinct(), "links")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _agreeing(met: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) that agree on enough of the probe's units to be linked.

    ``met(x, y, role)``: probe x met y in a bucket.  Every unit on which they don't agree
    is a difference at least, so two linked sets agree on all units but H.  That holds
    where y is not the smaller one (it files all that x may pick).
    """
    size = classes.select("id", "size")
    credit = 1 + (F.col("role").bitwiseAND(TWICE) > 0).cast("int")
    found = met.groupBy("x", "y").agg(F.sum(credit).alias("agreed"))
    found = found.join(size.select(F.col("id").alias("x"), F.col("size").alias("size_x")), "x").join(
        size.select(F.col("id").alias("y"), F.col("size").alias("size_y")), "y")

    def digits(name):
        return F.greatest(F.length(F.bin(name)), F.lit(Band.FIRST))

    top = F.when(digits("size_x") == digits("size_y"), F.pow(F.lit(2.0), digits("size_x")) - 1)
    largest = F.least(top, F.floor(F.col("size_x") * 100 / PERCENT))
    x, y = F.col("size_x"), F.col("size_y")
    enough = F.col("agreed") >= _allowed(x, largest) + 1 - _allowed(x, y)
    fits = 100 * F.least("size_x", "size_y") >= PERCENT * F.greatest("size_x", "size_y")
    return found.where(fits & enough).select(*_pair("x", "y")).distinct()


def _mixed(rows: DataFrame, links: DataFrame) -> DataFrame:
    """The rows of buckets with members of several components, with their component and
    whether it is the one most of the bucket's members are in (``major``)."""
    rows = rows.drop("component", "major").join(components(links), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    w = Window.partitionBy("key")
    rows = rows.select("*", F.min("component").over(w).alias("low"), F.max("component").over(w).alias("high"))
    rows = materialize(rows.where("low <> high").drop("low", "high"), "mixed")
    most = rows.groupBy("key", "component").count().groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"))
    rows = rows.join(most, "key").withColumn("major", F.col("component") == F.col("main")).drop("main")
    return materialize(rows, "mixed-parts")


def _star(rows: DataFrame, eligible: Column, classes: DataFrame) -> DataFrame:
    """Probes with one member of their bucket: of the eligible filed ones the most central,
    that is, the one that shares its segments with most others.  So a text and its many
    edited copies meet in the text itself, not in one of the copies."""
    filed = eligible & (F.col("role").bitwiseAND(INDEX) > 0)
    best = F.max(F.when(filed, F.struct("score", "id", "component"))).over(Window.partitionBy("key"))
    met = rows.withColumn("pivot", best).where(
        (F.col("role").bitwiseAND(PROBE) > 0) & (F.col("component") != F.col("pivot.component")))
    return materialize(_agreeing(met.select(F.col("id").alias("x"), F.col("pivot.id").alias("y"), "role"),
                                 classes), "stars")


def _across(rows: DataFrame, done: DataFrame, classes: DataFrame) -> DataFrame:
    """Probes and filed sets of one bucket that are in different components.

    Pairs are made of the members outside the bucket's main component with all, so a large
    group of copies is not compared with itself; those whose sketches show that they can't
    be linked are not even made.
    """
    rows = rows.join(classes.select("id", "parity"), "id")

    def side(role, name):
        return rows.where(F.col("role").bitwiseAND(role) > 0).select("key", *[
            F.col(c).alias(f"{c}_{name}") for c in ("id", "component", "major", "size", "role", "parity")])

    probes, filed = side(PROBE, "x"), side(INDEX, "y")
    differ = (F.col("component_x") != F.col("component_y")) & (F.col("size_x") <= F.col("size_y")) & (
        100 * F.col("size_x") >= PERCENT * F.col("size_y")) & (
        _apart("parity_x", "parity_y") <= _allowed(F.col("size_x"), F.col("size_y")))
    found = probes.where("NOT major_x").join(filed, "key").where(differ).unionByName(
        probes.where("major_x").join(filed.where("NOT major_y"), "key").where(differ))
    met = found.select(F.col("id_x").alias("x"), F.col("id_y").alias("y"), F.col("role_x").alias("role"))
    return materialize(_agreeing(met, classes).join(done, ["a", "b"], "left_anti"), "across")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rounds: int = 0) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links).

    ``rounds``: how often the members outside a bucket's main component are compared with
    one of theirs before all that are still apart are; the result is the same.  Worth while
    where groups of copies have no bucket of their own.
    """
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    own = own.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).withColumn(
        "spread", F.xxhash64("doc_id", "text_hash"))
    rows = _shared(own, 0)
    documents = rows.where(F.col("role") == DOCUMENT).select(
        "doc_id", "id", "size", "text_hash", "parity")
    shared, seed = rows.where(F.col("role") != DOCUMENT), 0
    lacking = shared.where(F.col("role") == SHORT).count()
    while lacking:
        seed += 1
        more = _shared(own, seed)
        lacking = more.where(F.col("role") == SHORT).count()
        shared = shared.unionByName(more)
    shared = shared.where(F.col("role") != SHORT).select("key", "id", "role", "shared_by")
    first = F.min(F.struct("doc_id", "text_hash", "parity"))
    classes = materialize(documents.where("doc_id IS NOT NULL AND size > 0").groupBy("id", "size")
                          .agg(first.alias("first")).select("id", "size", "first.*"), "classes")
    scores = shared.where(F.col("role").bitwiseAND(INDEX) > 0).groupBy("id").agg(
        F.sum("shared_by").alias("score")).join(classes.select("id", "size"), "id")
    rows = shared.drop("shared_by").join(scores, "id").withColumn("component", F.col("id"))
    done = _star(rows, F.lit(True), classes)
    links = _verified(done, classes, own)
    rows = _mixed(rows, links)
    for _ in range(rounds):
        if rows.isEmpty():
            break
        star = _star(rows, ~F.col("major"), classes).join(done, ["a", "b"], "left_anti")
        new = _verified(star, classes, own)
        done, links = done.unionByName(star), links.unionByName(new)
        if new.isEmpty():
            break
        rows = _mixed(rows, links)
    links = links.unionByName(_verified(_across(rows, done, classes), classes, own))
    parts = components(links)
    named = parts.join(classes.select("id", "doc_id"), "id").groupBy("component").agg(
        F.min("doc_id").alias("component_id"))
    named = parts.join(named, "component").select("id", "component_id")
    labels = classes.join(named, "id", "left").select(
        "id", "size", F.coalesce("component_id", "doc_id").alias("component_id"))
    return documents.join(labels, ["id", "size"], "left").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are the least of their component, with all their columns; of
    rows repeated in all columns one stays.  Documents without id or words all stay."""
    found = materialize(similar(docs, id_col, text_col), "similar")
    ids = docs[id_col]
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    twice = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_twice")).count().where(
        "count > 1").select("_twice")
    gone = materialize(gone, "gone")
    few = gone.count() <= SENT_IDS  # then the texts need no shuffle
    kept = docs.join(F.broadcast(gone) if few else gone, ids == gone["_gone"], "left_anti")
    if twice.isEmpty():
        return kept
    again = kept[id_col] == twice["_twice"]
    return kept.join(twice, again, "left_anti").unionByName(
        kept.join(twice, again, "left_semi").dropDuplicates())
