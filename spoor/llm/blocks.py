"""Distinct tokens of blocks of documents, looked up once each over the whole corpus.

A row per token would be far larger than the texts.  Instead each task cuts its
documents into blocks of bounded size and writes, per block, its documents as numbers
into the block's own list of distinct tokens, and that list dealt over buckets by the
token's hash.  A bucket meets the lists of all blocks, so a distinct token is seen by
one place only, which can count it or work it out once; the answers go back to the
blocks and are put in the places of the tokens.

Each block names a token once, however often its documents repeat it, so no token is
hot.  Blocks and buckets are rows of packed arrays in a table in the shared folder.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import Batches, in_arrow, sliced, texts, tidied
from spoor.session import Stored, store

#: Bytes of text in a block (one text at least).
BLOCK_BYTES = 16_000_000

SCHEMA = "block string, bucket int, payload binary"

#: Bytes of text to a bucket: its lists, which hold less, meet in one call.
BUCKET_BYTES = 16_000_000

_LEVEL = 9


def _planes(numbers: np.ndarray) -> bytes:
    """Unsigned numbers by sevens of bits: the low bits of all, then the next of those
    that have more, and so on."""
    small = numbers.dtype.itemsize <= 4 and numbers.dtype.kind != "i"
    rest, out = numbers.astype(np.uint32 if small else np.uint64, copy=False), []
    while True:
        more = rest >= 128
        out.append((rest & rest.dtype.type(127)).astype(np.uint8) | (more.view(np.uint8) << np.uint8(7)))
        if not more.any():
            return b"".join(p.tobytes() for p in out)
        rest = rest[more] >> rest.dtype.type(7)


def _numbers(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    out, at, shift = (raw[:n] & 127).astype(np.int64), n, 7
    which = np.flatnonzero(raw[:n] > 127)
    while len(which):
        plane = raw[at : at + len(which)]
        at += len(which)
        out[which] |= (plane & 127).astype(np.int64) << shift
        which, shift = which[plane > 127], shift + 7
    return out


def pack(*parts: np.ndarray | bytes, level: int = _LEVEL) -> bytes:
    """Arrays of numbers from 0 and byte strings as one compressed string."""
    out = []
    for p in parts:
        if isinstance(p, np.ndarray):
            body = _planes(p)
            out.append(b"n %d %d\n" % (len(p), len(body)) + body)
        else:
            out.append(b"b 0 %d\n" % len(p) + p)
    return zstandard.ZstdCompressor(level=level).compress(b"".join(out))


def unpack(data: bytes) -> list:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        end = raw.index(b"\n", at)
        kind, n, size = raw[at:end].split(b" ")
        body, at = raw[end + 1 : end + 1 + int(size)], end + 1 + int(size)
        out.append(_numbers(body, int(n)) if kind == b"n" else body)
    return out


def pack_words(words: list[bytes], *more: np.ndarray, level: int = _LEVEL) -> bytes:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return pack(sizes, b"".join(words), *more, level=level)


def unpack_words(data: bytes) -> tuple[list[bytes], list[np.ndarray]]:
    sizes, blob, *more = unpack(data)
    ends = np.cumsum(sizes).tolist()
    return [blob[a:b] for a, b in zip([0, *ends[:-1]], ends)], more


@dataclass
class Documents:
    """The documents of a block: ids (None: null), flags, the tokens' numbers of each, and
    the bucket of each number."""

    ids: list[int | None]
    flags: list[bool]
    tokens: list[np.ndarray]
    buckets: np.ndarray

    def packed(self) -> bytes:
        null = np.array([i is None for i in self.ids], bool)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64).view(np.uint64)
        sizes = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        return pack(null, ids, np.array(self.flags, bool), sizes, np.concatenate(self.tokens), self.buckets.astype(np.uint32))

    @classmethod
    def unpacked(cls, data: bytes) -> Documents:
        null, ids, flags, sizes, flat, buckets = unpack(data)
        flat = flat.astype(np.uint32)
        return cls([None if n else i for n, i in zip(null.tolist(), ids.tolist())],
                   (flags > 0).tolist(), np.split(flat, np.cumsum(sizes)[:-1]), buckets)


class _Block:
    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.ids, self.flags, self.tokens, self.size = [], [], [], 0

    def add(self, doc_id, flag, size: int, tokens: list[bytes]) -> None:
        number = self.number
        self.tokens.append(np.fromiter((number.setdefault(t, len(number)) for t in tokens), np.uint32,
                                       len(tokens)))
        self.ids.append(doc_id)
        self.flags.append(bool(flag))
        self.size += size

    def rows(self, buckets: int, counted: bool, level: int = _LEVEL):
        """The documents, with tokens numbered by falling frequency (in powers of two), then
        by bucket, so that the buckets pack to next to nothing, then by themselves, so that
        alike ones pack together, and the tokens of each bucket by number; ``counted``: with
        how often flagged documents hold them."""
        name, words = uuid.uuid4().hex, sorted(self.number)
        numbers = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.number = {}  # the words alone are needed from here on
        count = np.bincount(np.concatenate(self.tokens), minlength=len(words))
        where = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % buckets
        order = np.lexsort((where, -np.frexp(count[numbers])[1]))
        rank = np.empty(len(words), np.uint32)
        rank[numbers[order]] = np.arange(len(words))
        words, where = [words[i] for i in order], where[order]
        tokens = self.tokens = [rank[t] for t in self.tokens]
        yield name, -1, Documents(self.ids, self.flags, tokens, where).packed()
        more = []
        if counted:
            seen = [t for t, flag in zip(tokens, self.flags) if flag]
            more = [np.bincount(np.concatenate([np.empty(0, np.uint32), *seen]), minlength=len(words))]
        order = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[order], np.arange(buckets + 1))
        for b in range(buckets):
            part = order[edges[b] : edges[b + 1]]
            if len(part):
                yield name, b, pack_words([words[i] for i in part], *[m[part] for m in more], level=level)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows), (pa.string(), pa.int32(), pa.binary()))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns],
                                      [c.split()[0] for c in SCHEMA.split(", ")])


def cut(docs: DataFrame, tokens: Callable[[], Callable[[bytes], list[bytes]]],
        counted: bool = False, size: int = BLOCK_BYTES, level: int = _LEVEL) -> DataFrame:
    """The table that ``stored`` writes."""
    return stored(docs, tokens, counted, size, level).df


def stored(docs: DataFrame, tokens: Callable[[], Callable[[bytes], list[bytes]]],
           counted: bool = False, size: int = BLOCK_BYTES, level: int = _LEVEL,
           least: int = 0) -> Stored:
    """The table of blocks of ``docs(doc_id, flag, text)``; ``tokens`` makes the function
    that parts a text; ``counted``: tokens come with their count in flagged documents;
    ``level``: that of the tokens' compression; ``least``: bytes of text to a bucket where
    the session has partitions for more buckets."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if least:
        buckets = max(1, min(buckets, -(-total // least)))
    buckets = max(buckets, -(-total // BUCKET_BYTES))

    def make():
        parted = tokens()

        def run(batches: Batches) -> Batches:
            held = _Block()
            for batch in sliced(batches):
                ids = batch.column("doc_id").to_pylist()
                flags = batch.column("flag").to_pylist()
                for doc_id, flag, text in zip(ids, flags, texts(batch, "text")):
                    held.add(doc_id, flag, len(text), parted(text))
                    if held.size >= size:
                        yield _batch(list(held.rows(buckets, counted, level)))
                        held = _Block()
            if held.ids:
                yield _batch(list(held.rows(buckets, counted, level)))

        return run

    return store(in_arrow(docs.select("doc_id", "flag", "text"), make, SCHEMA), "blocks")


def answered(table: DataFrame, answer: Callable[[list[list[bytes]], list[list[np.ndarray]]], list],
             schema: str = "block string, bucket int, payload binary") -> DataFrame:
    """``answer`` gets the word lists of a bucket and their counts, a list each per block,
    and returns a payload each whose arrays follow the order of the words."""

    def run(t: pa.Table) -> pa.Table:
        lists = [unpack_words(x) for x in t.column("payload").to_pylist()]
        out = answer([w for w, _ in lists], [a for _, a in lists])
        del lists
        tidied()
        return pa.table({"block": t.column("block"), "bucket": t.column("bucket"),
                         "payload": pa.array(out, pa.binary())})

    words = table.where("bucket >= 0")
    return words.groupBy("bucket").applyInArrow(run, schema)


def distinct(lists: list[list[bytes]]) -> tuple[list[bytes], list[np.ndarray]]:
    """The distinct words of several lists, and where each list's words are among them."""
    number: dict[bytes, int] = {}
    places = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
              for words in lists]
    return list(number), places


def finished(table: DataFrame, answers: DataFrame,
             finish: Callable[[Documents, Answers], pa.Table], schema: str) -> DataFrame:
    """``finish`` gets the documents of a block and their answers, and returns rows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        docs = Documents.unpacked(left.column("payload")[0].as_py())
        buckets, payloads = (right.column(c).to_pylist() for c in ("bucket", "payload"))
        tidied()
        return finish(docs, Answers(docs.buckets, {b: unpack(x) for b, x in zip(buckets, payloads)}))

    docs = table.where("bucket < 0").select("block", "payload")
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


class Answers:
    """What the buckets said about the words of a block, in the order of their numbers."""

    def __init__(self, buckets: np.ndarray, parts: dict[int, list]):
        self.size, self.parts = len(buckets), parts
        order = np.argsort(buckets, kind="stable")
        cuts = np.cumsum(np.bincount(buckets, minlength=1))[:-1]
        self.numbers = dict(enumerate(np.split(order, cuts)))

    def values(self, column: int) -> np.ndarray:
        """One number per word."""
        out = np.zeros(self.size, np.int64)
        for b, arrays in self.parts.items():
            out[self.numbers[b]] = arrays[column]
        return out

    def lists(self, sizes: int, flat: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and numbers, where each word has a list of numbers, given as bytes."""
        offsets = np.concatenate([[0], np.cumsum(self.values(sizes))])
        out = np.zeros(int(offsets[-1]), kind)
        for b, arrays in self.parts.items():
            count = arrays[sizes]
            first = np.cumsum(count) - count
            at = np.repeat(offsets[self.numbers[b]] - first, count) + np.arange(int(count.sum()))
            out[at] = np.frombuffer(arrays[flat], kind)
        return offsets, out
