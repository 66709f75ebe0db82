"""Quality rules by host.

Every document is measured against simple rules.  The share of a host's documents that
fail one is a noisy rate for a small host, so it is shrunk towards the rate of all
hosts: the rates of the hosts fit a beta prior (method of moments), and a host's
verdict is taken from its posterior mean.  The verdict goes back to all its documents.

Cases: a null or empty text has no words and fails; documents of null host share one
host; one host, or hosts of equal rates, give a strong prior around the overall rate; an
empty table gives an empty result; repeated rows are measured and returned each; very long
texts are measured whole; further columns are left aside (``quality``) or kept
(``filtered``), also where their names are used here.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import Batches, covered, in_arrow, inside, packed, texts, window_codes
from spoor.session import materialize

# Symbols counted, words in a repeated window, least words of a document,
# percent of words in repeated windows that fails.
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = SYMBOLS.encode()


@dataclass(frozen=True)
class HostRules:
    """Documents that count as failing for their host, and when a host is rejected.

    ``symbol_pct``, ``dup_line_pct``: symbols per 100 characters of words, repeated lines
    per 100 words, above which a document fails.  ``most``: the largest shrunk rate of a
    host that is kept.
    """

    symbol_pct: int = 10
    dup_line_pct: int = 10
    most: float = 0.5


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """The measures of one text, in the order of MEASURES."""
    words = text.split()
    joined = b"".join(words)
    word_chars = len(joined.decode())
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    repeated = 0
    if len(words) > WINDOW:
        _, which, count = np.unique(window_codes(ids, WINDOW), return_inverse=True,
                                    return_counts=True)
        starts = np.flatnonzero(count[which] > 1)
        repeated = int(covered(starts, WINDOW, len(words)).sum()) if len(starts) else 0
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated


def _measured(batches: Batches) -> Batches:
    """The columns but the last, which is the text, and the measures."""
    for batch in batches:
        yield _with_measures(batch, batch.schema.names[:-1], texts(batch, "text"))


def _with_measures(batch: pa.RecordBatch, kept: list[str], said: list[bytes]) -> pa.RecordBatch:
    found = np.array([measure(t) for t in said], np.int64).reshape(-1, 5)
    return pa.RecordBatch.from_arrays(
        [batch.column(c) for c in kept] + [pa.array(found[:, i]) for i in range(5)],
        kept + list(MEASURES))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             host_col: str = "source") -> DataFrame:
    """id, host and the measures of each document, with ``base_failed`` and ``failed``."""
    df = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{host_col}`").cast("string").alias("host"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = "id long, host string, " + ", ".join(f"{m} long" for m in MEASURES)
    return in_arrow(df, lambda: _measured, schema)


def judged(stats: DataFrame, rules: HostRules) -> DataFrame:
    base = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return stats.withColumn("base_failed", base).withColumn("failed", base | (
        100 * F.col("n_symbols") > rules.symbol_pct * F.col("word_chars")
    ) | (100 * F.col("n_dup_lines") > rules.dup_line_pct * F.col("n_words")))


def host_verdicts(stats: DataFrame, rules: HostRules = HostRules()) -> DataFrame:
    """host, n_docs, n_failed, shrunk (posterior mean of the rate), host_kept.

    The prior is two numbers fitted to all hosts: mean and variance of the hosts' rates,
    the variance less what sampling alone gives.
    """
    hosts = judged(stats, rules).groupBy("host").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    hosts = materialize(hosts, "hosts")
    rate = F.col("n_failed") / F.col("n_docs")
    fit = hosts.agg(  # one row
        F.count("*").alias("k"), F.avg(rate).alias("mean"), F.var_pop(rate).alias("var"),
        F.avg(1 / F.col("n_docs")).alias("inverse")).first()
    alpha, beta = beta_prior(fit["k"], fit["mean"] or 0.0, fit["var"] or 0.0,
                             fit["inverse"] or 0.0)
    shrunk = (F.col("n_failed") + F.lit(alpha)) / (F.col("n_docs") + F.lit(alpha + beta))
    return hosts.withColumn("shrunk", shrunk).withColumn(
        "host_kept", F.col("shrunk") <= F.lit(rules.most))


def beta_prior(hosts: int, mean: float, variance: float, inverse: float) -> tuple[float, float]:
    """alpha, beta by moments; the prior weighs between 1 and 1,000 documents."""
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    spread = mean * (1 - mean)
    between = variance - spread * inverse
    weight = 1000.0 if hosts < 2 or between <= spread / 1001 else spread / between - 1
    weight = min(max(weight, 1.0), 1000.0)
    return mean * weight, (1 - mean) * weight


def quality(docs: DataFrame, rules: HostRules = HostRules(), id_col: str = "doc_id",
            text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, host, shrunk, kept."""
    stats = materialize(measured(docs, id_col, text_col, host_col), "measures")
    hosts = host_verdicts(stats, rules).withColumnRenamed("host", "of_host")
    joined = judged(stats, rules).join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    return joined.select(
        F.col("id").alias("doc_id"), *MEASURES, "base_failed",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"), "host", "shrunk")


def filtered(docs: DataFrame, rules: HostRules = HostRules(), id_col: str = "doc_id",
             text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that ``quality`` keeps, with all their columns.

    Texts are measured twice, for their hosts and for themselves, and so never moved or
    stored beside their measures; only the rejected hosts meet them.
    """
    hosts = host_verdicts(measured(docs, id_col, text_col, host_col), rules)
    rejected = materialize(hosts.where("NOT host_kept").select(F.col("host").alias("of_host")),
                           "rejected-hosts")
    own = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    df = own.select(packed(own).alias("row"), F.col(f"`{host_col}`").cast("string").alias("host"))

    def run(batches: Batches) -> Batches:
        for batch in batches:  # the text goes to the task once, in its row
            yield _with_measures(batch, ["row", "host"], inside(batch, "row", text_col))

    row = df.schema["row"].dataType.simpleString()
    stats = in_arrow(df, lambda: run, f"row {row}, host string, " + ", ".join(f"{m} long" for m in MEASURES))
    kept = judged(stats, rules).where(~F.col("base_failed")).join(
        rejected, F.col("host").eqNullSafe(F.col("of_host")), "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])
