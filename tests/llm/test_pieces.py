import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from spoor.llm import blocks, pieces, queries
from spoor.llm.common import sliced

PATH = public_tokenizers.path("piece_bpe_32k.model")

MORE = [" lead", "trail  ", "a   b\n\n  c", "▁▁ x ▁", "\n", "\n\nx", "tab\tx\r\n y", "ﬁ Ａ é", "x\x00y",
        "日本語 テキスト", " ", "nbsp here", "<s>a</s> <unk> <0x0A>", "  \n  "]


def library(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    ids = [sp.encode(t or "", add_bos=True, add_eos=True) for t in texts]
    return [(len(x), np.array(x, "<u4").tobytes(), sp.decode(x)) for x in ids]


def check(frame):
    rows = [tuple(r) for r in frame.select("doc_id", "text").collect()]
    want = sorted((repr(i), *x) for (i, _), x in zip(rows, library([t for _, t in rows])))
    for make in (pieces.encoded, pieces.whole_texts):
        got = sorted((repr(r["doc_id"]), r["n_tokens"], bytes(r["ids"]), r["text"])
                     for r in make(frame, PATH).collect())
        assert got == want


def test_edges(edge, spark):
    check(edge)
    check(spark.createDataFrame(list(enumerate(MORE)), "doc_id long, text string"))


def test_documents(spark, small, docs):
    check(docs)
    row = queries.op6_pieces(spark, small).where("doc_id = 0").first()
    (n, ids, text), = library([docs.where("doc_id = 0").first()["text"]])
    assert tuple(row) == (0, n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_each_distinct_chunk_is_encoded_once_per_corpus(docs, spark):
    """Several blocks share their chunks: same ids however the texts are cut."""
    table = blocks.cut(pieces._input(docs, "doc_id", "text"), pieces._chunks(PATH), size=20_000)
    assert table.select("block").distinct().count() > 5
    found = blocks.finished(table, blocks.answered(table, pieces._encode(PATH)),
                            pieces._finish(PATH), pieces._OUT)
    want = {r["doc_id"]: bytes(r["ids"]) for r in pieces.encoded(docs, PATH).collect()}
    assert {r["doc_id"]: bytes(r["ids"]) for r in found.collect()} == want


def test_empty(edge):
    assert pieces.encoded(edge.limit(0), PATH).count() == 0


def test_packing():
    words = [b"", b"a\nb", "é".encode()]
    got, (n,) = blocks.unpack_words(blocks.pack_words(words, np.array([1, 2, 3 << 40])))
    assert got == words and n.tolist() == [1, 2, 3 << 40]
    parts = [np.empty(0, np.int64), b"x\n", np.array([0, 127, 128, 1 << 63], np.uint64), b""]
    assert [x.tolist() if isinstance(x, np.ndarray) else x for x in blocks.unpack(blocks.pack(*parts))] == [
        [], b"x\n", [0, 127, 128, -(1 << 63)], b""]
    docs = blocks.Documents([None, -5, 7], [True, False, True], [np.array([0, 2]), np.empty(0, np.int64),
                                                               np.array([1])], np.array([3, 0, 3]))
    back = blocks.Documents.unpacked(docs.packed())
    assert (back.ids, back.flags) == (docs.ids, docs.flags)
    assert [t.tolist() for t in back.tokens] == [[0, 2], [], [1]] and back.buckets.tolist() == [3, 0, 3]
    answers = blocks.Answers(back.buckets, {0: [np.array([2]), bytes([8, 9])], 3: [np.array([1, 0]), bytes([7])]})
    assert answers.values(0).tolist() == [1, 2, 0]
    offsets, flat = answers.lists(0, 1, "u1")
    assert offsets.tolist() == [0, 1, 3, 3] and flat.tolist() == [7, 8, 9]


def test_alike_chunks_spread_over_many_buckets(spark, monkeypatch):
    """Chunks with one beginning are no group of their own, and more text has more buckets."""
    text = "\n".join(f"        https://example.com/{i}" for i in range(4000))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    monkeypatch.setattr(blocks, "BUCKET_BYTES", len(text) // 16)
    table = blocks.cut(pieces._input(frame, "doc_id", "text"), pieces._chunks(PATH))
    sizes = [len(blocks.unpack_words(bytes(r["payload"]))[0]) for r in table.where("bucket >= 0").collect()]
    assert len(sizes) >= 16 and sum(sizes) >= 4000 and max(sizes) < 2 * sum(sizes) / len(sizes)
    check(frame)


def test_the_buckets_of_a_block_pack_to_little():
    """Numbers rise with the bucket among words of like frequency, and lead back to the words."""
    block = blocks._Block()
    texts = [[b"w%d" % (i * 7919 % 6007) for i in range(k, k + 900)] for k in range(0, 9000, 700)]
    for i, words in enumerate(texts):
        block.add(i, False, 1, words)
    (_, _, packed), *lists = block.rows(48, False, 15)
    docs = blocks.Documents.unpacked(packed)
    assert len(blocks.pack(docs.buckets.astype(np.uint32))) < len(docs.buckets) // 8
    numbers = blocks.Answers(docs.buckets, {}).numbers
    word = {n: w for _, b, x in lists for n, w in zip(numbers[b].tolist(), blocks.unpack_words(x)[0])}
    assert [[word[n] for n in t.tolist()] for t in docs.tokens] == texts


def test_results_of_a_block_come_in_small_batches(monkeypatch):
    """What a block or a bucket gives is made part by part, and is the same."""
    monkeypatch.setattr(pieces, "OUT_BYTES", 300)
    monkeypatch.setattr(pieces, "AT_ONCE", 7)
    texts = [" ".join(f"word{i * k % 41} é{i}" for i in range(12)) + "\n" for k in range(30)] + [""]
    block, chunks = blocks._Block(), pieces._chunks(PATH)()
    for i, text in enumerate(texts):
        block.add(i, False, len(text), chunks(text.encode()))
    (_, _, packed), *lists = block.rows(3, False, 15)
    answers = {b: blocks.unpack(pieces._encode(PATH)([blocks.unpack_words(x)[0]], [[]])[0])
               for _, b, x in lists}
    docs = blocks.Documents.unpacked(packed)
    got = pieces._finish(PATH)(docs, blocks.Answers(docs.buckets, answers))
    assert len(got.to_batches()) > 5
    want = pieces.model(PATH).encode(texts, add_bos=True, add_eos=True)
    assert [np.frombuffer(x, "<u4").tolist() for x in got.column("ids").to_pylist()] == want
    assert got.column("doc_id").to_pylist() == list(range(31))
    assert got.column("text").to_pylist() == pieces.model(PATH).decode(want)


def test_batches_are_sliced():
    batch = pa.RecordBatch.from_pydict({"a": list(range(1201))})
    parts = list(sliced(iter([batch, batch.slice(0, 0)])))
    assert [p.num_rows for p in parts] == [500, 500, 201]
    assert [x for p in parts for x in p.column("a").to_pylist()] == list(range(1201))
