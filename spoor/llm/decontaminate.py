"""Benchmark decontamination with suffix arrays over the training documents.

Each task joins the word sequences of its documents to shards of bounded size and sorts
the suffixes of a shard on their first words (as many as the longest window).  Every
suffix of every benchmark item is looked up in it by binary search; the range found
holds all places where it occurs, and matching places on one diagonal join to the
longest verbatim match.  Documents with a match of a whole window are contaminated.

Only suffixes that begin like some benchmark suffix (on their first two words) are
sorted: no other can hold a match.  The benchmark is cut into blocks of bounded size;
each block is sent to the tasks and the documents pass by once per block.

Cases: null or wordless documents and items have no match; an item of fewer words than a
window is one window; equal windows of several items count for each of them; repeated
rows give a row each; an empty benchmark leaves every document clean; an item without an
id is searched as well: its hits count, all such items count as one, and the digest of the
items leaves them out; very long texts are searched whole; further columns are left aside
(``contamination``) or kept (``cleaned``), also where their names are used here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import Batches, covered, in_arrow, inside, packed, pick
from spoor.session import materialize

# Fixed value: words in a window.
WINDOW = 10
#: Characters of benchmark text sent to the tasks at once, words in a shard.
BLOCK_CHARS, SHARD_WORDS = 8_000_000, 2_000_000

# Letters in lower case, digits and everything beyond ASCII make words; the rest parts them.
_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class Block:
    """Windows of some benchmark items, ready to be looked up."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        sequences = []
        for _, text in items:
            w = words(text)
            sequences.append([self.number.setdefault(x, len(self.number) + 1) for x in w])
        self.item_ids = [i for i, _ in items]
        owners: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for item, seq in enumerate(sequences):
            size = min(window, len(seq))
            for at in range(len(seq) - size + 1 if size else 0):
                owners.setdefault(tuple(seq[at : at + size]), []).append((item, at))
        self.windows = sorted(owners)
        self.owners = [owners[w] for w in self.windows]
        self.sizes = np.array([len(w) for w in self.windows], np.int64)
        pad = [w + (0,) * (window - len(w)) for w in self.windows]
        self.keys = np.array(pad, ">u4").reshape(-1, window)
        self.base = len(self.number) + 1
        self.heads = np.unique(np.array(
            [w[0] * self.base + w[1] for w in self.windows if len(w) > 1], np.int64))
        self.singles = np.unique(np.array([w[0] for w in self.windows if len(w) == 1], np.int64))

    def ids(self, found: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in found), np.int64, len(found))

    def occurrences(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the shard and the windows that occur there.

        ``ids`` has the documents one after the other, with 0 for a word in no item and
        between documents.
        """
        none = np.empty(0, np.int64)
        if not len(ids) or not len(self.windows):
            return none, none
        after = np.append(ids[1:], 0)
        at = np.flatnonzero((ids > 0) & (after > 0))
        starts = at[np.isin(ids[at] * self.base + after[at], self.heads)]
        if len(self.singles):
            starts = np.union1d(starts, np.flatnonzero(np.isin(ids, self.singles)))
        if not len(starts):
            return none, none
        # The suffix array of the shard, on as many words as a window has.
        padded = np.append(ids, np.zeros(self.window, np.int64))
        suffixes = padded[starts[:, None] + np.arange(self.window)].astype(">u4")
        suffixes = np.ascontiguousarray(suffixes).view(f"S{4 * self.window}").ravel()
        order = np.argsort(suffixes, kind="stable")
        array, starts = suffixes[order], starts[order]
        # All suffixes with the window's words in front: from the window followed by
        # nothing to the window followed by the largest number.
        low = np.ascontiguousarray(self.keys).view(f"S{4 * self.window}").ravel()
        high = self.keys.copy()
        high[np.arange(self.window)[None, :] >= self.sizes[:, None]] = 0xFFFFFFFF
        high = np.ascontiguousarray(high).view(f"S{4 * self.window}").ravel()
        first = np.searchsorted(array, low, "left")
        count = np.searchsorted(array, high, "right") - first
        which = np.repeat(np.arange(len(first)), count)
        begin = np.cumsum(count) - count
        return starts[np.repeat(first - begin, count) + np.arange(int(count.sum()))], which


def matches(block: Block, places: np.ndarray, which: np.ndarray) -> list[tuple[int, int, int]]:
    """(item, place, words) of the longest verbatim matches, from a document's places."""
    cells = sorted((item, place - at, place, int(block.sizes[w]))
                   for place, w in zip(places.tolist(), which.tolist())
                   for item, at in block.owners[w])
    runs: list[list[int]] = []
    for item, diagonal, place, size in cells:
        if runs and runs[-1][:2] == [item, diagonal] and place <= runs[-1][2] + runs[-1][3]:
            runs[-1][3] = max(runs[-1][3], place + size - runs[-1][2])
        else:
            runs.append([item, diagonal, place, size])
    return [(item, place, size) for item, _, place, size in runs]


def _found(docs: list[bytes], block: Block) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of each document its number of words and the places of windows in it.

    A shard is the word numbers of some documents, one after the other; the words
    themselves are held for one document at a time.
    """
    shard: list[np.ndarray] = []
    total = 0
    for i, text in enumerate(docs):
        shard.append(block.ids(words(text)))
        total += len(shard[-1]) + 1
        if total < SHARD_WORDS and i < len(docs) - 1:
            continue
        gap = np.zeros(1, np.int64)
        begins = np.cumsum([0] + [len(s) + 1 for s in shard])
        places, which = block.occurrences(np.concatenate([x for s in shard for x in (s, gap)]))
        order = np.argsort(places, kind="stable")
        places, which = places[order], which[order]
        cut = np.searchsorted(places, begins)
        for k, s in enumerate(shard):
            part = slice(cut[k], cut[k + 1])
            yield len(s), places[part] - begins[k], which[part]
        shard, total = [], 0


_STATE = ("n_words long, n_hit long, hit binary, items array<string>, "
          "matches array<struct<item_id: string, start: long, words: long>>")


def _search(block: Block, first: bool, column: str):
    """Adds a block's findings to the state columns of the documents, whose texts are the
    ``column`` of ``row``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            size = batch.num_rows
            old = [None] * size if first else zip(*(
                batch.column(c).to_pylist() for c in ("hit", "items", "matches")))
            n_words, n_hit, hits, items, spans = [], [], [], [], []
            docs = inside(batch, "row", column)
            for (length, places, which), before in zip(_found(docs, block), old):
                hit = covered(places, block.sizes[which], length)
                named = {block.item_ids[i] for w in np.unique(which) for i, _ in block.owners[w]}
                runs = [{"item_id": block.item_ids[i], "start": s, "words": n}
                        for i, s, n in matches(block, places, which)] if len(places) else []
                if before:
                    earlier = np.unpackbits(np.frombuffer(before[0], np.uint8))[:length]
                    hit, runs = hit | (earlier > 0), before[2] + runs
                    named |= set(before[1])
                n_words.append(length)
                n_hit.append(int(hit.sum()))
                hits.append(np.packbits(hit).tobytes())
                items.append(sorted(named, key=lambda x: (x is None, x or "")))
                spans.append(runs)
            kinds = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()),
                                        ("words", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string())), pa.array(spans, kinds)],
                ["row", "n_words", "n_hit", "hit", "items", "matches"])

    return run


def blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text",
           window: int = WINDOW, most: int = BLOCK_CHARS) -> Iterator[Block]:
    """The benchmark in blocks of at most ``most`` bytes (or one item), one at a time."""
    rows = pick(benchmark, item=item_col, text=text_col).select(
        F.col("item").cast("string"), F.col("text").cast("string")).where("text IS NOT NULL")
    held, size, any_yet = [], 0, False
    for item, text in rows.toLocalIterator():
        data = text.encode()
        if held and size + len(data) > most:
            yield Block(held, window)
            held, size, any_yet = [], 0, True
        held.append((item, data))
        size += len(data)
    if held or not any_yet:
        yield Block(held, window)


def searched(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
             block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Each document as ``row`` with n_words, hit (bits), items and matches."""
    own = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    df = own.select(packed(own).alias("row"))
    schema = f"row {df.schema['row'].dataType.simpleString()}, {_STATE}"
    sc = docs.sparkSession.sparkContext
    first = True
    for block in blocks(benchmark, item_col, item_text_col, window, block_chars):
        if not first:
            df = materialize(df, "decontaminated")
        sent = sc.broadcast(block)  # at most block_chars of text
        df = in_arrow(df, lambda sent=sent, first=first: _search(sent.value, first, text_col), schema)
        first = False
    return df


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest, matches."""
    own = pick(docs, id=id_col, text=text_col)  # texts go to the tasks once
    found = searched(own, benchmark, "text", **options)
    return found.select(
        F.col("row")["id"].alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["words"])),
                   F.lit(0).cast("long")).alias("longest"), "matches")


def cleaned(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
            **options) -> DataFrame:
    """The documents without any match, with all their columns."""
    found = searched(docs, benchmark, text_col, **options).where(F.size("items") == 0)
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])
