"""URL filter: fixed rules, and association rules mined from labelled URLs.

Fixed rules name a host and a path prefix; they hold for subdomains and the longest
fitting one wins.  URLs that no fixed rule judges are judged by mined rules: FP-growth
finds combinations of URL tokens that go with the label "block"; those of enough support
and confidence are kept, less those that a shorter rule already covers.  Where URLs hold
more tokens than FP-growth can combine, the same rules are found level by level.  A URL meets
only the rules filed under one of its tokens (each rule under its rarest), and is
blocked if it holds all tokens of one.

Cases: a null URL or one without ``://`` has empty host and path and no token, and is
allowed; without labels or without a strong combination nothing is blocked by the
method; very long URLs are read whole; of fixed rules of equal length that fit, the one
last by name, then by verdict, wins; repeated rows give a row each; further columns are
left aside.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.session import materialize

BLOCK, ALLOW = "block", "allow"
#: Blocked labelled URLs that a rule must hold for, the share of those it holds for that
#: must be blocked, and classes of a labelled URL of which FP-growth lists all combinations.
MIN_ROWS, MIN_CONFIDENCE, MOST_CLASSES = 20, 0.8, 10
_LABEL = "label:block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, F.lit("://")) + 3)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.when(F.instr(url, F.lit("://")) > 0, host).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substr(url, F.instr(url, F.lit("://")) + 3)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, F.lit("://")) > 0, path).otherwise("")


def judged(rules: list[Rule], host: Column, path: Column) -> Column:
    """The longest fitting rule as struct(length, rule, verdict); null if none fits."""
    fits = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host)))
               & F.startswith(path, F.lit(r.path)),
               F.struct(F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("rule"),
                        F.lit(r.verdict).alias("verdict")))
        for r in rules]
    none = F.lit(None).cast("struct<length: int, rule: string, verdict: string>")
    return F.array_max(F.array(none, *fits))


def tokens(url: Column) -> Column:
    """Distinct tokens: labels of the host, parts of the path, names of the query."""
    host, path = host_of(url), path_of(url)
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x))
    parts = F.transform(F.split(F.lower(path), "/"), lambda x: F.concat(F.lit("path:"), x))
    asked = F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1),
                                 F.lit(r"(?:^|&)([^=&]+)"), F.lit(1))
    query = F.transform(asked, lambda x: F.concat(F.lit("query:"), F.lower(x)))
    every = F.array_distinct(F.concat(labels, parts, query))
    found = F.filter(every, lambda t: ~t.isin("host:", "path:", "query:"))
    none = F.array().cast("array<string>")
    return F.when(F.instr(url, F.lit("://")) > 0, F.array_sort(found)).otherwise(none)


@dataclass(frozen=True)
class Mined:
    """``rules``: classes, key (the rarest class), confidence, rows; ``members``: token,
    class.  A URL holds a class if it holds one of its tokens."""

    rules: DataFrame
    members: DataFrame


def classes(labelled: DataFrame, min_rows: int) -> DataFrame:
    """token, class, share (of its rows that are blocked) and blocked rows of the tokens of
    at least ``min_rows`` blocked rows; ``labelled(row, tokens, block)``.

    Tokens that occur in the same rows are one class, named by the first: as tokens of a
    combination they would say the same, and any subset of them would be a rule.
    """
    cells = labelled.select("row", "block", F.explode("tokens").alias("token"))
    row = F.col("row")
    held = cells.groupBy("token").agg(
        F.count("*").alias("n"), F.sum(F.col("block").cast("long")).alias("blocked"),
        F.bit_xor(F.xxhash64(row, F.lit(1))).alias("x"), F.bit_xor(F.xxhash64(row, F.lit(2))).alias("y"))
    held = held.where(F.col("blocked") >= min_rows)
    alike = held.groupBy("n", "x", "y").agg(F.min("token").alias("class"), F.collect_list("token").alias("tokens"),
                                            F.max(F.col("blocked") / F.col("n")).alias("share"),
                                            F.max("blocked").alias("blocked"))
    return alike.select("class", F.explode("tokens").alias("token"), "share", "blocked")


def _by_growth(items: DataFrame, n: int, min_rows: int, min_confidence: float) -> DataFrame:
    """Rules of several classes, by FP-growth over ``n`` rows of items, which lists every
    combination of what is frequent together."""
    labelled = items.select(F.when(
        F.col("block"), F.array_append("held", F.lit(_LABEL))).otherwise(F.col("held")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=(min_rows - 0.5) / n, minConfidence=min_confidence).fit(labelled)
    strong = model.associationRules.where(
        (F.col("consequent") == F.array(F.lit(_LABEL))) & (F.size("antecedent") > 1)
    ).select(F.array_sort("antecedent").alias("classes"), "confidence",
             F.round(F.col("support") * n).cast("long").alias("rows"))
    strong = materialize(strong, "rules")
    # A rule that holds all classes of a shorter rule says nothing more.
    filed = _filed(strong, items)
    short, cell = filed.select(F.col("classes").alias("short"), "key"), F.explode("classes").alias("key")
    covered = filed.select("classes", cell).join(short, "key").where(
        (F.size("short") < F.size("classes")) & (F.size(F.array_except("short", "classes")) == 0)
    ).select("classes").distinct()
    return filed.join(covered, "classes", "left_anti")


def _by_level(items: DataFrame, min_rows: int, min_confidence: float) -> DataFrame:
    """The same rules where rows hold too many classes to list all combinations.

    Combinations of one class more are made of those of a level that may still lead to a
    rule: they hold for enough blocked rows, are no rule (a longer one would say nothing
    more) and hold for fewer rows than each of their parts (with as many they would say the
    same as the part, and so would all that is made of them).  So a level is as long as what
    the rows tell apart, not as the number of their subsets.
    """
    rows = materialize(items.groupBy("held").agg(
        F.count("*").alias("n"), F.sum(F.col("block").cast("long")).alias("blocked")).withColumn(
        "id", F.monotonically_increasing_id()), "class-sets")
    none = F.array().cast("array<string>")
    holds = materialize(rows.select("id", "n", "blocked", none.alias("head"), F.explode("held").alias("last")), "level")
    whole = F.array_append("head", F.col("last")).alias("classes")
    open_sets = holds.groupBy(whole).agg(F.sum("n").alias("n"))
    strong = None
    while not open_sets.isEmpty():
        ahead = holds.select("id", "head", F.col("last").alias("next"))
        longer = materialize(holds.join(ahead, ["id", "head"]).where("last < next").select(
            "id", "n", "blocked", whole.alias("head"), F.col("next").alias("last")), "level")
        found = longer.groupBy(whole).agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked"))
        found = found.where(F.col("blocked") >= min_rows)
        parts = found.select("*", F.explode("classes").alias("out")).select(
            "classes", "n", "blocked", F.array_remove("classes", F.col("out")).alias("part"))
        met = parts.join(open_sets.select(F.col("classes").alias("part"), F.col("n").alias("part_n")), "part")
        told = materialize(met.groupBy("classes", "n", "blocked").agg(
            F.count("*").alias("parts"), F.min("part_n").alias("least")).where(
            (F.col("parts") == F.size("classes")) & (F.col("n") < F.col("least"))).select(
            "classes", "n", "blocked", (F.col("blocked") / F.col("n")).alias("confidence")), "told")
        rules = told.where(F.col("confidence") >= min_confidence).select(
            "classes", "confidence", F.col("blocked").alias("rows"))
        strong = rules if strong is None else strong.unionByName(rules)
        open_sets = told.where(F.col("confidence") < min_confidence).select("classes", "n")
        holds = longer.join(open_sets.select(
            F.slice("classes", F.lit(1), F.size("classes") - 1).alias("head"),
            F.element_at("classes", -1).alias("last")), ["head", "last"], "left_semi")
    return _filed(strong, items)


def _filed(strong: DataFrame, items: DataFrame) -> DataFrame:
    """Rules under the rarest of their classes."""
    single = items.select(F.explode("held").alias("class")).groupBy("class").agg(F.count("*").alias("freq"))
    rarest = strong.select("classes", F.explode("classes").alias("class")).join(
        single, "class").groupBy("classes").agg(F.min_by("class", F.struct("freq", "class")).alias("key"))
    return strong.join(rarest, "classes").select("classes", "key", "confidence", "rows")


def mined(labelled: DataFrame, min_rows: int = MIN_ROWS, min_confidence: float = MIN_CONFIDENCE,
          url_col: str = "url", block_col: str = "block", most_classes: int = MOST_CLASSES) -> Mined:
    """Rules from labelled URLs that hold for at least ``min_rows`` blocked ones.

    A class that is a rule by itself takes no part in combinations: they would say nothing
    more.  Of all other classes of a URL rules are made, by FP-growth if no URL holds more
    than ``most_classes`` of them, else level by level; the rules are the same.
    """
    rows = labelled.where(F.col(block_col).isNotNull()).select(
        tokens(F.col(url_col)).alias("tokens"), F.col(block_col).cast("boolean").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    rows = materialize(rows, "labelled-urls")
    members = materialize(classes(rows, min_rows), "token-classes")
    alone = members.where(F.col("share") >= min_confidence).select(
        F.array("class").alias("classes"), F.col("class").alias("key"), F.col("share").alias("confidence"),
        F.col("blocked").alias("rows")).distinct()
    others = members.where(F.col("share") < min_confidence)
    items = rows.select("row", "block", F.explode("tokens").alias("token")).join(others, "token").groupBy(
        "row", "block").agg(F.array_sort(F.collect_set("class")).alias("held"))
    items = materialize(items.select("block", "held"), "items")
    n, widest = items.agg(F.count("*"), F.max(F.size("held"))).first()
    kept = alone
    if n >= min_rows:
        combined = (_by_growth(items, n, min_rows, min_confidence) if widest <= most_classes
                    else _by_level(items, min_rows, min_confidence))
        kept = alone.unionByName(combined)
    kept = materialize(kept, "pruned-rules")
    used = kept.select(F.explode("classes").alias("class")).distinct()
    return Mined(kept, materialize(members.join(used, "class").select("token", "class"), "members"))


def blocked_sets(sets: DataFrame, found: Mined) -> DataFrame:
    """The token sets (column ``tokens``) that hold all classes of some rule, by the
    inverted index of the rules."""
    index = found.rules.select("key", F.col("classes").alias("needed"))
    held = sets.select("tokens", F.explode("tokens").alias("token")).join(found.members, "token").groupBy(
        "tokens").agg(F.collect_set("class").alias("held"))
    return held.select("tokens", "held", F.explode("held").alias("key")).join(index, "key").where(
        F.size(F.array_except("needed", "held")) == 0).select("tokens").distinct()


def filtered(pages: DataFrame, rules: list[Rule], labelled: DataFrame, id_col: str = "page_id",
             url_col: str = "url", min_rows: int = MIN_ROWS,
             min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule (null: none fits), verdict of every URL."""
    url = F.col("url")
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    rows = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"),
                       tokens(url).alias("tokens"))
    rows = rows.withColumn("own", judged(rules, F.col("host"), F.col("path")))
    hits = blocked_sets(rows.where("own IS NULL").select("tokens").distinct(),
                        mined(labelled, min_rows, min_confidence))
    hits = hits.select(F.col("tokens").alias("hit"))
    return rows.join(hits, F.col("own").isNull() & (F.col("tokens") == F.col("hit")), "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(F.col("hit").isNotNull(), BLOCK).otherwise(ALLOW))
        .alias("verdict"))
