"""Descriptors, rules and probes derived from the test tables, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.model import RULE_SCHEMA, Descriptors
from spoor.operators.accesslog import descriptors_from_log
from spoor.session import application_folder

MICROS = "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({} AS TIMESTAMP_NTZ))"
SECONDS_PER_DAY = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accesses of users (objects) by event type (class), in seconds."""
    return (
        table(spark, sf_dir, "events")
        .withColumn("ord1", F.expr(MICROS.format("ts")))
        .selectExpr(
            "event_type AS fd_id",
            "user_id AS obj",
            "ord1 div 1000000 AS sec",
            "ord1",
            "event_id AS ord2",
            "CAST(value * 100 + 0.5 AS BIGINT) AS sz",
        )
    )


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accesses of parts (objects) by supplier group (class), in days."""
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("ord1", F.expr(MICROS.format("l_shipdate")))
        .selectExpr(
            "concat('g', l_suppkey % 20) AS fd_id",
            "l_partkey AS obj",
            "ord1 div 86400000000 AS sec",
            "ord1",
            "l_orderkey * 10 + l_linenumber AS ord2",
            "CAST(l_quantity AS BIGINT) AS sz",
        )
    )


#: Classes of the bundled rule sets, their groups, and classes of a group more or less.
BUNDLE_CLASSES, BUNDLE_GROUPS = 2046, 40


def parts_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accesses of suppliers (objects) by class of part, in days: as many classes as the
    bundled rule sets name."""
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("ord1", F.expr(MICROS.format("l_shipdate")))
        .selectExpr(
            f"concat('c', l_partkey % {BUNDLE_CLASSES}) AS fd_id",
            "l_suppkey AS obj",
            "ord1 div 86400000000 AS sec",
            "ord1",
            "l_orderkey * 10 + l_linenumber AS ord2",
            "CAST(l_quantity AS BIGINT) AS sz",
        )
    )


LOGS = {"events": (events_log, 1), "lineitem": (lineitem_log, SECONDS_PER_DAY),
        "parts": (parts_log, SECONDS_PER_DAY)}

_built: dict[tuple[str, str, str], Descriptors] = {}


def descriptors(spark: SparkSession, sf_dir: str, source: str) -> Descriptors:
    """The descriptors of a log, as the operators find them: stored as tables, with
    the neighbours of each row.  Built once per application and data folder, like
    descriptor files that many jobs read."""
    key = (spark.sparkContext.applicationId, sf_dir, source)
    if key not in _built:
        make_log, unit = LOGS[source]
        with application_folder():  # they outlive the query that asks for them first
            _built[key] = descriptors_from_log(make_log(spark, sf_dir), unit)
    return _built[key]


EVENT_CLASSES = ["click", "error", "purchase", "signup", "view"]


def rule(
    mix_id: str, ord_: int, fd_id: str, op: str = "add", scale: float = 1.0,
    scale_type: str = "absolute", n: int = 0, m: int = 0,
) -> tuple:
    return (mix_id, ord_, fd_id, op, scale, scale_type, n, m, 0, 0, 0, 0)


HALF_ALL = [rule("half_all", i, c, scale=0.5) for i, c in enumerate(EVENT_CLASSES)]
ONE_ALL = [rule("one_all", i, c) for i, c in enumerate(EVENT_CLASSES)]
MIXED_OPS = [
    rule("mixed_ops", 0, "click", scale=2.0),
    rule("mixed_ops", 1, "view", "sub", 0.5),
    rule("mixed_ops", 2, "error", scale=50.0, scale_type="traffic"),
    rule("mixed_ops", 3, "signup", n=2, m=16),
    rule("mixed_ops", 4, "absent"),
]
JOB_RULES = [*[(("job"), *r[1:]) for r in MIXED_OPS], rule("job", 5, "purchase", scale=0.0)]
GROUPS = [rule(f"m{i % 4}", i // 4, f"g{i}", scale=0.5) for i in range(20)]
SHRUNK = [rule(f"s{i % 3}", i // 3, f"g{i}", scale=3.0) for i in range(20)]
FLAT = [rule("flat", i, f"m{i}") for i in range(4)]
# the first class is taken away again: its IATs fall silent half way
CANCELLING = [rule("cancelling", 0, "click"), rule("cancelling", 1, "view"),
              rule("cancelling", 2, "click", "sub"), rule("cancelling", 3, "error", scale=0.5)]
SUBTRACT = [rule("difference", 0, "click"), rule("difference", 1, "view", "sub", 0.5)]
PAIR = [rule("pair", 0, "click"), rule("pair", 1, "view")]
TENTH = [rule("tenth", i, c, scale=0.1, n=3, m=7) for i, c in enumerate(EVENT_CLASSES)]
CONCAT = [("three", 0, "click", 1.0), ("three", 1, "view", 1.0), ("three", 2, "error", 1.0),
          ("scaled", 0, "click", 2.0), ("scaled", 1, "signup", 1.0),
          ("broken", 0, "click", 1.0), ("broken", 1, "absent", 1.0)]
SHARED_CACHE = [("pair", "click"), ("pair", "view"), ("all", "click"), ("all", "view"),
                ("all", "error"), ("all", "signup"), ("all", "purchase"), ("one", "error")]


def literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table written out in the plan itself."""
    names, types = zip(*[c.split() for c in schema.split(", ")])
    tuples = ", ".join("(" + ", ".join(repr(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {tuples} AS t({', '.join(names)})").select(
        *[F.col(n).cast(t).alias(n) for n, t in zip(names, types)]
    )


def rules(spark: SparkSession, *sets: list[tuple]) -> DataFrame:
    return literal(spark, [r for s in sets for r in s], RULE_SCHEMA)


def concat_rules(spark: SparkSession) -> DataFrame:
    return literal(spark, CONCAT, "concat_id string, ord int, fd_id string, scale double")


def sharers(spark: SparkSession) -> DataFrame:
    return literal(spark, SHARED_CACHE, "mix_id string, fd_id string")


def customer_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer map lines: every ninth customer lacks the class column's caret."""
    return table(spark, sf_dir, "customer").select(
        F.expr(
            "concat_ws(' ', c_custkey, c_nationkey, lower(c_mktsegment), CASE WHEN c_custkey % 9"
            " = 0 THEN concat('plain', c_custkey) ELSE concat('n', c_nationkey, '^',"
            " lower(substring(c_mktsegment, 1, 1)), '^cls_', c_custkey) END)"
        ).alias("value")
    )


def _spread(spark: SparkSession, sf_dir: str, axis: str, step: int, name: str) -> DataFrame:
    """One probe per event, spread over the whole axis of its class and a little beyond."""
    ends = descriptors(spark, sf_dir, "events").rows.groupBy("fd_id").agg(F.max(axis).alias("end"))
    return (
        table(spark, sf_dir, "events").withColumnRenamed("event_type", "fd_id").join(ends, "fd_id")
        .selectExpr("fd_id", f"(event_id * {step}) % (end + end div 16 + 2) AS {name}")
    )


def iat_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IATs to look up."""
    return _spread(spark, sf_dir, "delta_t", 7919, "t")


def mb_probes(spark: SparkSession, sf_dir: str, name: str = "target_mb") -> DataFrame:
    """Footprints to look up."""
    return _spread(spark, sf_dir, "mb", 104729, name)


def largest_mb(spark: SparkSession, sf_dir: str) -> int:
    """The largest footprint of the events classes, which limits and sizes are parts of."""
    return descriptors(spark, sf_dir, "events").rows.agg(F.max("mb")).first()[0]


def bundle_lines(spark: SparkSession) -> DataFrame:
    """``(fd_id, at, value)``: the lines of rule files shaped like the bundled ones, under
    the files' names, and of their manifest, which names one file too many."""
    ids = spark.range(BUNDLE_CLASSES)

    def file(name: str, line: str) -> DataFrame:
        return ids.selectExpr(f"{name} AS fd_id", "id AS at", f"{line} AS value")

    g = BUNDLE_GROUPS
    found = file(f"concat('g', id % {g}, '.mg1')", "concat('c', id, ' add 1')")
    for k in (3, 7):
        found = found.unionByName(file(f"concat('g', (id * {k} + {k}) % {g}, '.mg2')", "concat('c', id, ' add 0.5')"))
    flat = spark.range(g).selectExpr("'flat' AS fd_id", "id AS at", "concat('g', id, '.mg1 add 1') AS value")
    found = found.unionByName(flat)
    names = found.select("fd_id").distinct().selectExpr("'MANIFEST' AS fd_id", "0L AS at", "fd_id AS value")
    more = spark.sql("SELECT 'MANIFEST' AS fd_id, 1L AS at, 'gone.mg1' AS value")
    return found.unionByName(names).unionByName(more)
