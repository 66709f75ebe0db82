"""Mixing sources to target weights by thresholds on a hash.

Each source has a weight; the weights share a number of words, and no source gives more
than ``most`` times its size (the excess goes to the others by weight).  A source's target
is split into passes: whole ones, which take every document once more, and one that takes
a part.  That part is the documents whose hash lies below a threshold, so the documents of
a smaller budget are among those of a larger one and every run takes the same.

The threshold is found without sorting: words are summed by source and bucket of the hash,
the bucket in which the budget ends is cut into finer buckets, and only its documents are
read again, until it holds documents of one hash.  Such documents are equal in id and size;
of them as many are taken as come nearest to the budget.

Everything runs as DataFrame expressions.  Histograms have ``2 ** BITS`` rows per source at
most; what reaches the driver is a row of sums per round of sharing.

Cases: a null or empty text has size 0 and is taken 0 times; documents of null source are
one source, the last; a source without words has target 0 and its weight goes to the others;
repeated rows count each and are taken apart from each other; an empty table gives an empty
result; further columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.llm.common import numbered, pick, text_or_empty
from spoor.session import materialize

# Weights of the sources in turn, words shared in percent of all words, how
# often a source may be taken at most.
WEIGHTS, SHARE_PCT, MOST = (3, 1, 2), 150, 2

#: Bits of the hash, and of it in one round of buckets.
HASH_BITS, BITS = 60, 12

WORD = r"[^\x20\x09-\x0D]++"


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def hash_of(doc_id: Column, size: Column) -> Column:
    """A number of HASH_BITS bits from a document's id and size."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), size.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """doc_id, source, size in words and hash of each document."""
    rows = pick(docs, doc_id=id_col, source=source_col, text=text_col).select(
        "doc_id", F.col("source").cast("string").alias("source"),
        n_words(text_or_empty("text")).alias("size"))
    return rows.withColumn("hash", hash_of(F.col("doc_id"), F.col("size")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_pct: int = SHARE_PCT,
            most: int = MOST) -> DataFrame:
    """source, source_size, target: the weights (in turn, by source, null last) share the
    words, and no target exceeds ``most`` times its source's size."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = numbered(totals, [F.col("source").asc_nulls_last()], name="nth")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("nth") % len(weights) + 1).cast("int"))
    sources = materialize(sources.select(
        "source", "source_size", weight.cast("double").alias("weight"),
        (F.col("source_size") * most).cast("double").alias("limit")), "sources")
    words, every = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n"),
                               F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).first()
    rest, room, before = share_pct * words / 100, every, None
    # The level rises with every round until no further source reaches its limit.
    while room and before != (rest, room):
        before = (rest, room)
        full = F.col("limit") * room <= F.col("weight") * rest
        held, room = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        rest = share_pct * words / 100 - held
    rest, room = before or (0.0, 1.0)
    share = F.when(F.col("limit") * room <= F.col("weight") * rest, F.col("limit")).otherwise(
        F.col("weight") * rest / room)
    return materialize(sources.select("source", "source_size", share.alias("target")), "targets")


def boundaries(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """Where each source's part ends: of_source, low and high hash of the last bucket, and
    how many of its documents (all of one hash) are taken; ``budgets(source, part)`` has
    the words of the part.

    Sources whose bucket holds a single document need no finer one; the loop ends when all
    are so, after HASH_BITS / BITS rounds at most.
    """
    ends, found = budgets.select(
        F.col("source").alias("of_source"), F.col("part").alias("left"), F.lit(0).cast("long").alias("prefix")), []
    for shift in range(HASH_BITS - BITS, -1, -BITS):
        held = sizes.join(ends, F.col("source").eqNullSafe(F.col("of_source")) & (
            F.shiftright("hash", shift + BITS) == F.col("prefix")))
        buckets = held.groupBy("of_source", "left", F.shiftright("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.max("size").alias("size"))
        upto = Window.partitionBy("of_source").orderBy("bucket")
        buckets = buckets.withColumn("upto", F.sum("words").over(upto))
        last = buckets.where(F.col("upto") > F.col("left")).groupBy("of_source").agg(
            F.min(F.struct("bucket", "upto", "words", "n", "size", "left")).alias("b"))
        last = materialize(last.select(
            "of_source", F.col("b.bucket").alias("prefix"), "b.n", "b.size",
            (F.col("b.left") - (F.col("b.upto") - F.col("b.words"))).alias("left")), "boundaries")
        fine = F.col("n") == 1 if shift else F.lit(True)
        found.append(last.where(fine).select(
            "of_source", F.shiftleft("prefix", shift).alias("low"),
            (F.shiftleft(F.col("prefix") + 1, shift) - 1).alias("high"), "n",
            F.floor(F.col("left") / F.col("size") + F.when(
                F.col("left") % F.col("size") * 2 > F.col("size"), 1.0).otherwise(0.0)).alias("taken_n")))
        ends = last.where(~fine).select("of_source", "left", "prefix")
        if ends.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return materialize(out, "thresholds")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share_pct: int = SHARE_PCT,
          most: int = MOST, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes, repeats counted) and
    times of each document."""
    sizes = materialize(sized(docs, id_col, text_col, source_col), "sizes")
    shared = targets(sizes, weights, share_pct, most)
    whole = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    shared = shared.withColumn("whole", whole).withColumn(
        "part", F.col("target") - F.col("whole") * F.col("source_size"))
    ends = boundaries(sizes, shared.select("source", "part"))
    plan = materialize(shared.join(ends, F.col("source").eqNullSafe(F.col("of_source")), "left").select(
        F.col("source").alias("from_source"), "source_size", "target", "whole", "low", "high", "n",
        "taken_n"), "mix-plan")
    rows = sizes.join(plan, F.col("source").eqNullSafe(F.col("from_source")))
    # Some, but not all, of several documents of one hash: they differ in nothing that the
    # result has, so their places in any order tell which are taken.
    some = (F.col("n") > 1) & (F.col("taken_n") > 0) & (F.col("taken_n") < F.col("n"))
    tied = some & F.col("hash").between(F.col("low"), F.col("high"))
    more = F.when(F.col("hash") < F.col("low"), 1).when(
        (F.col("hash") <= F.col("high")) & (F.col("taken_n") >= F.col("n")), 1).otherwise(0)
    if plan.where(some).isEmpty():
        counted = rows.withColumn("times", F.col("whole") + more)
    else:
        placed = numbered(rows.where(tied), [F.col("hash")], ("source",), "place")
        counted = rows.where(~F.coalesce(tied, F.lit(False))).withColumn(
            "times", F.col("whole") + more).unionByName(placed.withColumn(
                "times", F.col("whole") + (F.col("place") < F.col("taken_n")).cast("long")).drop("place"))
    return counted.select("doc_id", "size", "source_size", "target",
                          (F.col("size") * F.col("times")).cast("long").alias("taken"),
                          F.col("times").cast("long").alias("times"))
