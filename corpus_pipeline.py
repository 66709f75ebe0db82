"""From raw documents to token ids: quality, near copies, benchmark, secrets, encoding.

Each stage works on all documents the stage before kept.  The stages but the last return
the columns of ``documents``; the last returns the ids of every document left.

Cases: a document of null or empty text has too few words and goes in the first stage; of
documents repeated in all columns one stays; further columns are kept until the last stage;
an empty table gives an empty result; very long texts are read whole by every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.llm import decontaminate, ngram_join, pieces, quality, secrets
from spoor.llm.common import table
from spoor.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or whose host does, go."""
    return quality.filtered(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays: the one of least id."""
    return ngram_join.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.cleaned(docs, table(spark, sf_dir, "benchmark"))


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; the number of characters follows."""
    ratios = secrets.trained(docs, table(spark, sf_dir, "labels"))
    clean = secrets.redact(docs.withColumn("_before", F.length("text")), ratios)
    after = F.length("text")
    return clean.withColumn("n_chars", F.col("n_chars") + F.coalesce(
        after - F.col("_before"), F.lit(0))).drop("_before")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of every document, and the text decoded from them."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality_rules", quality_rules), ("near_copies", near_copies),
          ("benchmark_free", benchmark_free), ("secret_free", secret_free),
          ("token_ids", token_ids)]

#: SQL can't express near copies or pieces; the tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; each stage's rows are written to the
    shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace("_", "-"))
    return docs
