"""Secret scan: fixed patterns, and Markov models of random and ordinary strings.

The fixed patterns find assignments, access keys and long hex strings.  The method
adds strings that look drawn at random: two character Markov chains of order one, one
trained on random strings and one on ordinary identifiers, score every long token by
their log-likelihood ratio.

Everything runs as DataFrame expressions.  The two chains are tables of counts over a
fixed alphabet, so what reaches the driver is at most ``2 * SYMBOLS ** 2`` numbers.

Cases: a null or empty text has no span; a repeated row gives a row each; without
labelled samples both chains are uniform and the method adds nothing; a very long text, or
one of very many matches, takes time in proportion; further columns of the input are left
aside (``scan``) or kept as they are (``redact``), also where their names are used here.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import packed, pick, text_or_empty

# The patterns of the three base kinds and the shortest length of each
# (for an assignment: of its value).
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = {"assign": (ASSIGN, 6), "access": (ACCESS, 20), "hex": (HEX, 24)}

# What the method looks at: tokens of base64 and URL-safe base64 characters.
TOKEN_CHARS = 20
TOKEN = rf"[A-Za-z0-9+/_=-]{{{TOKEN_CHARS},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1  # and one for any other character

# A span: where it starts, its kind's rank, where it ends (exclusive), kind, value.
SPAN = "struct<start: int, rank: int, end: int, kind: string, value: string>"


#: Elements that a fold appends one by one: an array is folded part by part, since every
#: append copies what is there.  Characters of the parts a long text is cut into twice.
PART, LONG_PART, SHORT_PART = 256, 65_536, 4_096


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(x: Column, step, first: int = 0) -> Column:
    """All intermediate values of a fold over an array of ints, in linear time."""
    none = F.array().cast("array<int>")

    def part(at: Column, values: Column) -> Column:
        def add(acc, v):
            return _let(step(acc["at"], v), lambda n: F.struct(
                n.alias("at"), F.concat(acc["out"], F.array(n)).alias("out")))

        return F.aggregate(values, F.struct(at.alias("at"), none.alias("out")), add)

    def over(acc, values):
        return _let(part(acc["at"], values), lambda r: F.struct(
            r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    def whole(values: Column) -> Column:
        count = F.floor((F.size(values) - 1) / F.lit(PART)).cast("int")
        parts = F.transform(F.sequence(F.lit(0), count), lambda c: F.slice(values, c * PART + 1, F.lit(PART)))
        start = F.struct(F.lit(first).alias("at"), F.array().cast("array<array<int>>").alias("out"))
        return F.when(F.size(values) > 0, F.flatten(
            F.aggregate(parts, start, over, lambda acc: acc["out"]))).otherwise(none)

    return _let(x, whole)


def _sums(x: Column) -> Column:
    return _running(x, lambda at, v: at + v)


def _found(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """Leftmost non-overlapping matches with code-point offsets.

    The pieces between the matches give the offsets: ``split`` and
    ``regexp_extract_all`` walk over the same matches.
    """
    pieces = F.transform(F.split(text, pattern, -1), F.length)

    def spans(hits: Column) -> Column:
        ends = _sums(F.zip_with(F.slice(pieces, 1, F.size(hits)), hits, lambda n, hit: n + F.length(hit)))
        return F.zip_with(hits, ends, lambda hit, end: F.struct(
            (end - F.length(hit)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
            F.lit(kind).alias("kind"), hit.alias("value")))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.rlike(pattern), _let(hits, spans)).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """The spans of the three base kinds by start, then kind as listed."""
    parts = []
    for rank, (kind, (pattern, least)) in enumerate(KINDS.items()):
        if kind == "hex":  # maximal runs: short ones need not be built to be dropped
            pattern = f"[0-9a-f]{{{least},}}"
        found = _found(text, pattern, kind, rank)
        if kind == "assign":
            found = F.filter(
                found, lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= least)
        else:
            found = F.filter(found, lambda s: F.length(s["value"]) >= least)
        parts.append(found)
    return F.array_sort(F.concat(*parts))


def _pairs(text: Column) -> Column:
    """Numbers of the neighbouring characters of a string: first * SYMBOLS + second."""
    chars = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    return F.zip_with(F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))),
                      F.slice(chars, 2, F.greatest(F.size(chars) - 1, F.lit(0))),
                      lambda a, b: a * SYMBOLS + b)


def train(samples: DataFrame, text_col: str = "text", label_col: str = "random") -> list[float]:
    """Log-likelihood ratio of each pair of characters, from labelled strings.

    ``samples`` has strings and whether each is random; null strings or labels are left
    out.  Counts are add-one smoothed per first character.
    """
    pairs = pick(samples, text=text_col, random=label_col).where(
        "text IS NOT NULL AND random IS NOT NULL"
    ).select(F.col("random").cast("boolean").alias("random"),
             F.explode(_pairs(F.col("text"))).alias("pair"))
    counts = {False: [0] * SYMBOLS**2, True: [0] * SYMBOLS**2}
    for row in pairs.groupBy("random", "pair").count().collect():  # 2 * SYMBOLS^2 at most
        counts[row["random"]][row["pair"]] = row["count"]

    def log_rates(table: list[int]) -> list[float]:
        out = []
        for first in range(SYMBOLS):
            row = table[first * SYMBOLS : (first + 1) * SYMBOLS]
            total = math.log(sum(row) + SYMBOLS)
            out += [math.log(n + 1) - total for n in row]
        return out

    return [a - b for a, b in zip(log_rates(counts[True]), log_rates(counts[False]))]


def _left(tokens: Column, base: Column) -> Column:
    """The runs of tokens that no base span covers, of TOKEN_CHARS characters or more.

    Starts and ends of both kinds in one order: running counts tell which spans and which
    token are open between two of them.
    """
    def edge(at: Column, span: int, token: int) -> Column:
        return F.struct(at.alias("at"), F.lit(span).alias("span"), F.lit(token).alias("token"))

    def edges(spans: Column, span: int, token: int) -> Column:
        return F.concat(F.transform(spans, lambda x: edge(x["start"], span, token)),
                        F.transform(spans, lambda x: edge(x["end"], -span, -token)))

    def cut(marks: Column) -> Column:
        after = F.slice(F.transform(marks, lambda m: m["at"]), 2, F.size(marks))
        between = F.arrays_zip(
            F.transform(marks, lambda m: m["at"]).alias("at"), after.alias("end"),
            _sums(F.transform(marks, lambda m: m["span"])).alias("spans"),
            _sums(F.transform(marks, lambda m: m["token"])).alias("tokens"),
            _sums(F.transform(marks, lambda m: F.greatest(m["token"], F.lit(0)))).alias("nth"))
        free = F.filter(between, lambda x: (x["spans"] == 0) & (x["tokens"] == 1) & (
            x["end"] - x["at"] >= TOKEN_CHARS))
        return F.transform(free, lambda x: _let(F.element_at(tokens, x["nth"]), lambda token: F.struct(
            x["at"].alias("start"), token["rank"].alias("rank"), x["end"].alias("end"),
            token["kind"].alias("kind"),
            F.substring(token["value"], x["at"] - token["start"] + 1, x["end"] - x["at"]).alias("value"))))

    marks = F.array_sort(F.concat(edges(base, 1, 0), edges(tokens, 0, 1)))
    return F.when((F.size(base) == 0) | (F.size(tokens) == 0), tokens).otherwise(_let(marks, cut))


def random_spans(text: Column, base: Column, ratios: list[float], least: float) -> Column:
    """What the base spans (by start) leave of long tokens, where the mean ratio per
    character pair is ``least`` or more."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    free = _let(_found(text, TOKEN, "random", len(KINDS)),
                lambda t: _let(base, lambda b: _left(t, b)))
    score = lambda s: F.aggregate(
        _pairs(s["value"]), F.lit(0.0), lambda acc, p: acc + F.element_at(table, p + 1)
    ) / (F.length(s["value"]) - 1)
    return F.filter(free, lambda s: score(s) >= least)


#: Least mean log-likelihood ratio (nats per character pair) of a random string.
LEAST_RATIO = 0.3


def with_spans(docs: DataFrame, ratios: list[float], text_col: str = "text",
               least: float = LEAST_RATIO) -> DataFrame:
    """Each row as ``row``, its text (null: empty) and the arrays ``base`` and ``spans``."""
    df = docs.select(packed(docs).alias("row"), text_or_empty(f"`{text_col}`").alias("text"))
    df = df.withColumn("base", base_spans(F.col("text")))
    df = df.withColumn("added", random_spans(F.col("text"), F.col("base"), ratios, least))
    return df.select("row", "text", "base",
                     F.array_sort(F.concat("base", "added")).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                     s["end"].cast("string"))), ",")


def scan(docs: DataFrame, ratios: list[float], id_col: str = "doc_id",
         text_col: str = "text", least: float = LEAST_RATIO) -> DataFrame:
    """Per document: number of spans of each base kind, digest of the base spans, and
    all spans as ``kind:start:end`` (code points, end exclusive)."""
    found = with_spans(docs, ratios, text_col, least)
    n = lambda kind: F.size(
        F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("row")[id_col].alias("doc_id"), *[n(k) for k in KINDS],
                        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.col("spans")).alias("spans"))


def _gaps(text: Column, spans: Column) -> Column:
    """What lies before, between and behind spans (by start; overlapping ones are one).

    A gap is put together from short parts of the text, as a part of a text is found by
    walking to it.
    """
    upto = _running(F.transform(spans, lambda s: s["end"]), F.greatest)

    def gaps(ends: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), ends)
        opened = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text)))
        pairs = F.arrays_zip(before.alias("at"), opened.alias("end"))
        last = F.size(ends)
        return F.filter(pairs, lambda g, i: (g["end"] >= g["at"]) | (i == last))

    def parts(whole: Column, size: int, length: Column) -> Column:
        count = F.floor((F.greatest(length, F.lit(1)) - 1) / F.lit(size)).cast("int")
        return F.transform(F.sequence(F.lit(0), count), lambda k: F.substring(whole, k * size + 1, F.lit(size)))

    def piece(short: Column, gap: Column) -> Column:
        at, end = gap["at"], gap["end"]
        which = F.sequence(F.floor(at / F.lit(SHORT_PART)).cast("int"),
                           F.floor((end - 1) / F.lit(SHORT_PART)).cast("int"))
        return F.when(end > at, F.array_join(F.transform(which, lambda k: F.substring(
            F.element_at(short, k + 1), F.greatest(at - k * SHORT_PART, F.lit(0)) + 1,
            F.least(end, (k + 1) * SHORT_PART) - F.greatest(at, k * SHORT_PART))), "")).otherwise("")

    long = parts(text, LONG_PART, F.length(text))
    short = F.flatten(F.transform(long, lambda x: parts(x, SHORT_PART, F.length(x))))
    return _let(upto, lambda ends: _let(short, lambda s: F.transform(gaps(ends), lambda g: piece(s, g))))


def redact(docs: DataFrame, ratios: list[float], text_col: str = "text",
           least: float = LEAST_RATIO, mark: str = "<secret>") -> DataFrame:
    """The input with each span (overlapping ones as one) replaced by ``mark``; a null
    text stays null."""
    found = with_spans(docs, ratios, text_col, least)
    text = F.col("text")
    clean = _let(F.col("spans"), lambda s: F.array_join(_gaps(text, s), mark))
    clean = F.when(F.col("row")[text_col].isNotNull(),
                   F.when(F.size("spans") > 0, clean).otherwise(text))
    return found.select(*[
        (clean if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def random_samples(spark, n: int = 4000) -> DataFrame:
    """n strings drawn at random by hashing: base64, lower-case hex, mixed letters."""
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    b64 = F.translate(F.base64(F.unhex(digest)), "+/=", "")
    return spark.range(n).select(
        F.explode(F.array(b64, F.substring(F.upper(b64), 1, 24), F.translate(
            F.base64(F.unhex(digest)), "+/=", "-_"))).alias("text"), F.lit(True).alias("random"))


def identifier_samples(docs: DataFrame, labels: DataFrame, n: int = 2000) -> DataFrame:
    """Words of at most n documents labelled as good: ordinary identifiers.

    The n are those of least hash of the id, so the choice is the same in every run; the
    bound holds for the fit of the two chains alone.
    """
    chosen = (labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(n))
    words = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select(  # n rows at most
        F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z][A-Za-z0-9_-]{5,}"), F.lit(0)))
        .alias("text"))
    return words.where(~F.col("text").rlike(r"[0-9a-f]{24}|AKIA|[0-9].*[0-9].*[0-9]")).select(
        "text", F.lit(False).alias("random"))


def trained(docs: DataFrame, labels: DataFrame) -> list[float]:
    """The log-likelihood ratios from random strings and words of labelled documents."""
    return train(random_samples(docs.sparkSession).unionByName(identifier_samples(docs, labels)))
