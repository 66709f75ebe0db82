"""Token counts through a cache of digests.

The cache is a table of (content digest, tokenizer digest, count).  Documents are
digested, joined to the cache, and only the distinct contents it doesn't know are
encoded and appended.  Contents are normalised only where no tokenizer can tell the
difference (null is empty), so that a digest stands for one count; the digest of the
tokenizer is that of its file, so another version starts afresh.

Byte-level BPE files (.json) are encoded by tiktoken from their merge ranks, which gives
the counts of their library, tokenizers; texts on which tiktoken fails and other files go
to their library as they are.

Cases: a null text counts as empty and has no token; repeated rows give a row each and
are encoded once; an empty table adds nothing to the cache; a digest that several jobs
appended is one entry; very long texts are counted whole; further columns are left aside.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.llm.common import Batches, in_arrow
from spoor.session import new_path

# Fixed value: how byte-level BPE parts a text before it merges.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CACHE = "digest string, tokenizer string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes: printable ones for themselves, the others in
    order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def counter(path: str):
    """A function from a text to its number of tokens, as the file's library counts."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(model.encode(text))
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ranked = _ranked(spec)
    if ranked is None:
        return _library(json.dumps(spec))
    import tiktoken

    ranks, special = ranked
    encoding = tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks,
                                 special_tokens=special)
    names = set(special)

    def count(text: str) -> int:
        try:
            return len(encoding.encode(text, allowed_special=names, disallowed_special=()))
        except ValueError:  # a run of white space too long for tiktoken's pattern matching
            return _library(json.dumps(spec))(text)

    return count


@lru_cache(maxsize=2)
def _library(spec: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec)
    library.no_truncation()
    library.no_padding()
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


def _ranked(spec: dict):
    """Merge ranks by bytes and special tokens; None unless the file is plain byte-level
    BPE whose merges are numbered in the order they apply."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type") != "BPE" or spec.get("normalizer") or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space") or not before.get("use_regex", True)
            or model.get("ignore_merges") or model.get("dropout")
            or any(t["single_word"] or t["lstrip"] or t["rstrip"] or not t["special"]
                   for t in spec["added_tokens"])):
        return None
    letters, vocab = _byte_letters(), model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [vocab[a + b] for a, b in merges]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if order != sorted(order):
        return None
    ranks = {bytes(letters[c] for c in token): n for token, n in vocab.items()
             if token not in special}
    if any(bytes([b]) not in ranks for b in range(256)):
        return None
    return ranks, special


def _encode(path: str):
    def run(batches: Batches) -> Batches:
        count = counter(path)
        for batch in batches:
            n = [count(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(n, pa.int64())], ["digest", "n_tokens"])

    return run


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """The cache's entries of a tokenizer, one per digest: jobs that ran at the same time
    may have appended the same misses."""
    return spark.read.schema(CACHE).parquet(cache).where(F.col("tokenizer") == version).dropDuplicates(
        ["tokenizer", "digest"])


def update_cache(docs: DataFrame, cache: str, path: str, text_col: str = "text",
                 row_col: str = "doc_id") -> DataFrame:
    """Encode the contents the cache (a folder) doesn't know, append them, return the
    cache's rows of this tokenizer.

    Of equal contents one document is encoded, the one of least ``row_col``: so texts are
    moved by the id, which no hot content concentrates.
    """
    spark, version = docs.sparkSession, tokenizer_digest(path)
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    known = cached(spark, cache, version)
    held = docs.select(F.xxhash64(F.col(f"`{row_col}`")).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    held = held.withColumn("digest", F.sha2("text", 256))
    chosen = held.groupBy("digest").agg(F.min("row").alias("row")).join(
        known.select("digest"), "digest", "left_anti")
    misses = held.join(chosen, ["row", "digest"], "left_semi")
    counted = in_arrow(misses.select("digest", "text"), lambda: _encode(path),
                       "digest string, n_tokens long").dropDuplicates(["digest"])
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode(
        "append").parquet(cache)
    return cached(spark, cache, version)


def token_counts(docs: DataFrame, path: str, cache: str | None = None, limit: int = 512,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document.

    ``cache``: folder of the cache table; None: a new one in the shared folder.
    """
    cache = cache or new_path(docs.sparkSession, "token-cache")
    counts = update_cache(docs, cache, path, text_col, id_col).select("digest", "n_tokens")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.sha2(text, 256).alias("digest"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
