"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece has a whitespace marker behind another character, and none has a line
feed, no merge crosses the start of a marked word or a line feed.  A text then falls
into chunks that can be encoded apart: runs of markers with the word behind them, and
line feeds.  Each distinct chunk of the corpus is encoded once by the library (see
``blocks``), and the ids are joined back by the chunks' positions; the library's text of
each id gives the decoded text.  For
models where this doesn't hold, ``encoded`` raises; ``whole_texts`` is there for them.

Cases: a null or empty text has the begin and end ids only; repeated rows give a row
each; very long texts are encoded whole; an empty table gives an empty result; further
columns are left aside.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm import blocks
from spoor.llm.common import Batches, gathered, in_arrow

MARK = "▁"
#: Compression of distinct chunks and their ids, which are few beside the texts' chunks.
LEVEL = 15
#: Chunks encoded in one call, and bytes of ids and text in a batch of the result.
AT_ONCE, OUT_BYTES = 10_000, 4_000_000
_CHUNKS = re.compile(rb"\n| *[^ \n]+| +")


@lru_cache(maxsize=2)
def model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def chunkable(path: str) -> bool:
    """Whether chunks of the normalised text can be encoded apart."""
    sp = model(path)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not sp.is_control(i))
    apart = all(MARK not in p.lstrip(MARK) and "\n" not in p for p in pieces)
    kept = sp.normalize("a  b \n c ") == f"{MARK}a{MARK}{MARK}b{MARK}\n{MARK}c{MARK}"
    # A line feed in front shields a chunk from the marker that is put before a text.
    shield = sp.encode("\n")
    return apart and kept and len(shield) == 2 and sp.encode("\nab")[:2] == shield


def _chunks(path: str):
    def make():
        normalize = model(path).normalize

        def chunks(text: bytes) -> list[bytes]:
            return _CHUNKS.findall(normalize(text.decode()).replace(MARK, " ").encode())

        return chunks

    return make


def _encode(path: str):
    """Ids of every chunk of a bucket, each distinct chunk encoded once."""

    def answer(lists, _):
        words, places = blocks.distinct(lists)
        sp = model(path)
        kind = "<u2" if sp.get_piece_size() < 1 << 16 else "<u4"
        counts, parts = [np.empty(0, np.int64)], [np.empty(0, kind)]
        for first in range(0, len(words), AT_ONCE):
            ids = [x[2:] for x in sp.encode(["\n" + w.decode() for w in words[first : first + AT_ONCE]],
                                            num_threads=1)]
            counts.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            parts.append(np.fromiter((i for x in ids for i in x), kind, int(counts[-1].sum())))
        n, flat = np.concatenate(counts), np.concatenate(parts)
        at = np.concatenate([[0], np.cumsum(n)])
        return [blocks.pack(n[p], gathered(at, flat, p).tobytes(), level=LEVEL) for p in places]

    return answer


@lru_cache(maxsize=2)
def piece_texts(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by id and the bytes that each id stands for behind a line feed."""
    sp = model(path)
    feed = sp.encode("\n")[1]
    out = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        out.append(bytes([int(piece[1:-1], 16)]) if sp.is_byte(i) else
                   sp.decode([feed, i]).encode()[1:])
    return (np.concatenate([[0], np.cumsum([len(x) for x in out])]),
            np.frombuffer(b"".join(out), np.uint8))


_OUT = "doc_id long, n_tokens long, ids binary, text string"


def _rows(ids: list, n: list[int], packed: list[bytes], texts: list[bytes]) -> pa.Table:
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
        "ids": pa.array(packed, pa.binary()),
        "text": pa.array([t.decode(errors="replace") for t in texts], pa.string())})


def _finish(path: str):
    def finish(docs: blocks.Documents, answers: blocks.Answers) -> pa.Table:
        sp = model(path)
        begin, end = np.array([sp.bos_id()]), np.array([sp.eos_id()])
        id_at, id_flat = answers.lists(0, 1, "<u2" if sp.get_piece_size() < 1 << 16 else "<u4")
        text_at, text_flat = piece_texts(path)
        out, n, packed, texts, first, size = [], [], [], [], 0, 0
        for at, chunks in enumerate(docs.tokens, 1):
            ids = gathered(id_at, id_flat, chunks)
            text = gathered(text_at, text_flat, ids).tobytes()
            n.append(len(ids) + 2)
            packed.append(np.concatenate([begin, ids, end]).astype("<u4").tobytes())
            texts.append(text[1:] if text[:1] == b" " else text)  # the marker put before it
            size += len(packed[-1]) + len(text)
            if size >= OUT_BYTES or at == len(docs.tokens):
                out.append(_rows(docs.ids[first:at], n, packed, texts))
                n, packed, texts, first, size = [], [], [], at, 0
        return pa.concat_tables(out)

    return finish


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit, with begin and end ids) and
    the text decoded from them."""
    if not chunkable(path):
        raise ValueError("pieces of this model cross whitespace markers: use whole_texts")
    table = blocks.cut(_input(docs, id_col, text_col), _chunks(path), level=LEVEL)
    return blocks.finished(table, blocks.answered(table, _encode(path)), _finish(path), _OUT)


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.lit(False).alias("flag"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))


def whole_texts(docs: DataFrame, path: str, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The same for any model: each text as a whole through the library."""

    def run(batches: Batches) -> Batches:
        sp = model(path)
        for batch in batches:
            found = sp.encode([t or "" for t in batch.column("text").to_pylist()],
                              num_threads=1, add_bos=True, add_eos=True)
            table = _rows(batch.column("doc_id").to_pylist(), [len(x) for x in found],
                          [np.array(x, "<u4").tobytes() for x in found],
                          [x.encode() for x in sp.decode(found, num_threads=1)])
            yield from table.to_batches()

    return in_arrow(_input(docs, id_col, text_col), lambda: run, _OUT)
