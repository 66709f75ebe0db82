"""Descriptors from a stream of access-log lines.

Lines ``key:ts:md5:size:bytes:cpcode:serial:max_age`` arrive in time order.  Each
micro-batch adds, per class and IAT, what changed; the sum of all changes is the
table the batch build makes, so the descriptor can be finished at any time.

What has to be known of an object (accesses so far, last time, shortest IAT, largest size
of a re-access) lies in a state table in buckets of the object.  A batch numbers its
accesses by window functions, joined with the buckets it touches, and writes those anew.
All a batch writes goes to a folder of its own, which a batch that is run again replaces;
of a bucket the two latest versions are kept, so that a batch that is run again finds the
one it started from.  Changes of many batches are summed into one table now and then.

A line older than the last one of its object that an earlier batch has seen can't be
numbered any more: it is rejected, as are broken lines.  Within a batch the order of the
lines doesn't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoor.functions.numeric import aggregates, sums
from spoor.model import TRAFFIC_COLS
from spoor.session import removed

# Fields of a log line, separated by colons.
LINE_FIELDS = ["key", "ts", "md5", "size", "bytes", "cpcode", "serial", "max_age"]
LINE_SEPARATOR = ":"

CHANGE_COLS = [*TRAFFIC_COLS, "entering", "entering_size"]
CHANGE_SCHEMA = "fd_id string, delta_t bigint, " + ", ".join(f"{c} bigint" for c in CHANGE_COLS)
STATE_SCHEMA = "fd_id string, obj string, n bigint, last bigint, shortest bigint, size bigint"
REJECT_SCHEMA = "value string, reason string"

#: Buckets of the state table, and batches after which their changes are summed.
BUCKETS, COMPACT_AFTER = 16, 16

ACCESS_COLS = ["fd_id", "obj", "sec", "sz"]


def _fields(lines: DataFrame) -> DataFrame:
    words = F.split("value", LINE_SEPARATOR)

    def field(name: str):
        return F.get(words, F.lit(LINE_FIELDS.index(name)))

    return lines.select(
        "value",
        field("serial").alias("fd_id"),
        field("md5").alias("obj"),
        field("ts").try_cast("bigint").alias("sec"),
        field("bytes").try_cast("bigint").alias("sz"),
    )


_FAULT = (
    "CASE WHEN fd_id IS NULL THEN 'too few fields' WHEN sec IS NULL THEN 'bad time'"
    " WHEN sz IS NULL THEN 'bad size' END"
)


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines ``(value)`` -> accesses ``(fd_id, obj, sec, sz)``; broken lines are left to
    :func:`broken_lines`."""
    whole = " AND ".join(f"{c} IS NOT NULL" for c in ACCESS_COLS)
    return _fields(lines).filter(whole).select(ACCESS_COLS)


def broken_lines(lines: DataFrame) -> DataFrame:
    """The lines ``(value)`` that say no access, with a ``reason``."""
    return _fields(lines).selectExpr("value", f"{_FAULT} AS reason").filter("reason IS NOT NULL")


@dataclass(frozen=True)
class LiveTable:
    """What the batches have written below ``path``."""

    spark: SparkSession
    path: str
    buckets: int = BUCKETS

    def _found(self, pattern: str) -> list[str]:
        """Paths below the table that fit a glob, in their order by name."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        where = hadoop.Path(f"{self.path}/{pattern}")
        system = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return sorted(str(f.getPath()) for f in system.globStatus(where) or [])

    def folder(self, number: int) -> str:
        # as many digits as a long has: the order by name is that by number
        return f"{self.path}/batch={number:019d}"

    def _read(self, folders: list[str], schema: str) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        names = [c.split()[0] for c in schema.split(", ")]
        return self.spark.read.option("recursiveFileLookup", True).schema(schema).parquet(
            *folders).select(names)

    def _versions(self, before: int) -> dict[int, list[str]]:
        """The folders of each bucket's versions before a batch, by age."""
        held: dict[int, list[str]] = {}
        for path in self._found("batch=*/kind=state/bucket=*"):
            batch, bucket = (int(path.split(f"/{c}=")[1].split("/")[0]) for c in ("batch", "bucket"))
            if batch < before:
                held.setdefault(bucket, []).append(path)
        return held

    def state(self, before: int, buckets: list[int]) -> DataFrame:
        """The objects in the buckets, as batch ``before`` finds them."""
        held = self._versions(before)
        return self._read([held[b][-1] for b in buckets if b in held], STATE_SCHEMA)

    def tidy(self, number: int) -> None:
        """Drop versions that no batch can start from any more, and sum old changes."""
        for paths in self._versions(number).values():
            for old in paths[:-1]:
                removed(self.spark, old)
        changes = self._changes(number)
        if len(changes) >= COMPACT_AFTER:
            upto = f"{self.path}/summed/upto={number:019d}"
            self._summed(changes + self._sums()).write.mode("overwrite").parquet(upto)
            for old in [*changes, *self._sums()[:-1]]:
                removed(self.spark, old)

    def _sums(self) -> list[str]:
        return self._found("summed/upto=*")

    def _changes(self, upto: int | None = None) -> list[str]:
        """Folders of changes that are in no sum yet."""
        done = max((int(p.split("/upto=")[1]) for p in self._sums()), default=-1)
        found = ((int(p.split("/batch=")[1].split("/")[0]), p) for p in self._found("batch=*/kind=change"))
        return [p for n, p in found if n > done and (upto is None or n <= upto)]

    def _summed(self, folders: list[str]) -> DataFrame:
        return (
            self._read(folders, CHANGE_SCHEMA)
            .groupBy("fd_id", "delta_t")
            .agg(*aggregates(sums(CHANGE_COLS)))
        )

    def finished(self) -> DataFrame:
        """The traffic-by-IAT table as of now."""
        # an object whose shortest IAT fell leaves an empty entry behind
        return self._summed(self._changes() + self._sums()[-1:]).filter(
            " OR ".join(f"{c} <> 0" for c in CHANGE_COLS))

    def rejects(self) -> DataFrame:
        """Lines that could not be used, with a reason: broken or ``late``."""
        return self._read(self._found("batch=*/kind=reject"), REJECT_SCHEMA)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("fd_id", "obj"), F.lit(self.buckets)).cast("int")


def _met(lines: DataFrame, table: LiveTable, number: int) -> DataFrame:
    """Each line with its access or why it says none, and what is known of its object; the
    other objects of a touched bucket come along without a line, as a bucket is written
    whole."""
    parsed = _fields(lines).withColumn("reason", F.expr(_FAULT)).withColumn(
        "bucket", F.when(F.col("reason").isNull(), table.bucket()))
    touched = [r[0] for r in parsed.filter("reason IS NULL").select("bucket").distinct().collect()]
    state = table.state(number, touched).selectExpr(
        "fd_id", "obj", "n AS n0", "last AS last0", "shortest AS shortest0", "size AS size0")
    met = parsed.join(state, ["fd_id", "obj"], "full").withColumn(
        "reason", F.expr("if(sec < last0, 'late', reason)"))
    return met.withColumn("bucket", F.coalesce("bucket", F.when(F.col("n0").isNotNull(), table.bucket())))


def _outcome(met: DataFrame) -> DataFrame:
    """All that a batch adds, as one table: ``kind`` is change, state or reject."""
    key, inside = ["fd_id", "obj"], "OVER (PARTITION BY fd_id, obj ORDER BY sec, sz)"
    use = "value IS NOT NULL AND reason IS NULL"
    numbered = met.filter(use).selectExpr(
        "*",
        f"coalesce(n0, 0) + row_number() {inside} AS k",
        f"sec - coalesce(lag(sec) {inside}, last0) AS iat",
    )
    traffic = numbered.filter("k >= 2").selectExpr(
        "fd_id", "iat AS delta_t", "if(k >= 3, 1L, 0L) AS requests", "if(k >= 3, sz, 0L) AS bytes",
        "if(k = 2, sz, 0L) AS tr_bytes", "if(k = 2, 1L, 0L) AS tr_requests",
        "0L AS entering", "0L AS entering_size")
    after = numbered.groupBy("bucket", *key).agg(*aggregates({
        "n": "max(k)", "last": "max(sec)",
        "shortest": "least(max(shortest0), min(if(k >= 2, iat, NULL)))",
        "size": "greatest(max(size0), max(if(k >= 2, sz, NULL)))",
        "shortest0": "max(shortest0)", "size0": "max(size0)"}))
    # an object leaves its old place on the axis and enters at the new one
    moved = after.filter("shortest IS NOT NULL AND NOT (shortest <=> shortest0 AND size <=> size0)").selectExpr(
        "fd_id", "inline(array(named_struct('delta_t', shortest0, 'entering', -1L, 'entering_size', -size0),"
        " named_struct('delta_t', shortest, 'entering', 1L, 'entering_size', size)))").filter(
        "delta_t IS NOT NULL").selectExpr(
        "fd_id", "delta_t", *[f"0L AS {c}" for c in TRAFFIC_COLS], "entering", "entering_size")
    change = traffic.unionByName(moved).groupBy("fd_id", "delta_t").agg(*aggregates(sums(CHANGE_COLS)))
    state_cols = ["bucket", *key, "n", "last", "shortest", "size"]
    # objects without a line of use stay as they were
    kept = met.filter("bucket IS NOT NULL").groupBy("bucket", *key).agg(*aggregates({
        "n": "max(n0)", "last": "max(last0)", "shortest": "max(shortest0)", "size": "max(size0)",
        "_used": f"count_if({use})"})).filter("_used = 0 AND n IS NOT NULL")
    state = after.select(state_cols).unionByName(kept.select(state_cols))
    reject = met.filter("value IS NOT NULL AND reason IS NOT NULL").select("value", "reason")
    return (
        change.withColumn("kind", F.lit("change"))
        .unionByName(state.withColumn("kind", F.lit("state")), allowMissingColumns=True)
        .unionByName(reject.withColumn("kind", F.lit("reject")), allowMissingColumns=True)
    )


def start(lines: DataFrame, table: str, checkpoint: str, buckets: int = BUCKETS,
          **trigger) -> StreamingQuery:
    """Run the build over a stream of lines ``(value)``; see :class:`LiveTable` for what
    it leaves below ``table``.  The number of buckets belongs to the table for good."""

    def keep(batch: DataFrame, number: int) -> None:
        live = LiveTable(batch.sparkSession, table, buckets)
        met = _met(batch, live, number).persist()
        _outcome(met).write.mode("overwrite").partitionBy("kind", "bucket").parquet(live.folder(number))
        met.unpersist()
        live.tidy(number)

    return (
        lines.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
