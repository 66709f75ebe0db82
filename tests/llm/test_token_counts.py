import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spoor.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]


def test_counts(edge, docs, tmp):
    for frame in (edge, docs):
        rows = [(r[0], r[1] or "") for r in frame.select("doc_id", "text").collect()]
        want = sorted((repr(i), len(t.encode()), n, n > 512)
                      for (i, t), n in zip(rows, library([t for _, t in rows])))
        got = token_counts.token_counts(frame, PATH, f"{tmp}/cache").collect()
        assert sorted((repr(r[0]), *r[1:]) for r in got) == want


def test_cache_is_used_and_grows(spark, tmp):
    path = f"{tmp}/cache"
    frame = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None)], "doc_id long, text string")
    token_counts.token_counts(frame, PATH, path)
    assert spark.read.parquet(path).count() == 2
    # A stored count is taken as it is: the text isn't encoded again.
    rows = spark.read.parquet(path).selectExpr("digest", "tokenizer", "n_tokens + 1000 AS n_tokens")
    rows.write.parquet(f"{tmp}/altered")
    more = frame.union(spark.createDataFrame([(4, "new")], "doc_id long, text string"))
    got = {r["doc_id"]: r["n_tokens"]
           for r in token_counts.token_counts(more, PATH, f"{tmp}/altered").collect()}
    assert got == {1: 1002, 2: 1002, 3: 1000, 4: 1}
    assert spark.read.parquet(f"{tmp}/altered").count() == 3


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_go_to_their_library(spark, tmp, name):
    path = public_tokenizers.path(name)
    frame = spark.createDataFrame([(1, "Some WORDS, here."), (2, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(frame, path, f"{tmp}/c").collect()}
    if name.endswith(".json"):
        want = len(Tokenizer.from_file(path).encode("Some WORDS, here.", add_special_tokens=False).ids)
    else:
        import sentencepiece
        want = len(sentencepiece.SentencePieceProcessor(model_file=path).encode("Some WORDS, here."))
    assert got == {1: want, 2: 0}


def test_empty(edge, tmp):
    assert token_counts.token_counts(edge.limit(0), PATH, f"{tmp}/cache").count() == 0


def test_very_long_runs_of_white_space(spark, tmp):
    texts = ["a" + " " * 1_000_100 + "b", "\n" * 1_000_100, "x y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(frame, PATH, f"{tmp}/c").collect()}
    assert got == dict(enumerate(library(texts)))


def test_entries_that_jobs_appended_twice_are_one(spark, tmp):
    frame = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    for part in ("x", "y"):
        token_counts.token_counts(frame, PATH, f"{tmp}/{part}")
        spark.read.parquet(f"{tmp}/{part}").write.mode("append").parquet(f"{tmp}/both")
    assert spark.read.parquet(f"{tmp}/both").count() == 4
    got = sorted(map(tuple, token_counts.token_counts(frame, PATH, f"{tmp}/both").collect()))
    assert got == [(1, 3, 2, False), (2, 1, 1, False)]
