"""Thinning: keep a row only where the curve has moved far enough."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.functions.numeric import aggregates, sums
from spoor.model import ROW_COLS, TRAFFIC_COLS
from spoor.operators.scan import Running, scan
from spoor.session import materialize


def _least_step(x: str, pct: float) -> str:
    """The least whole growth of ``x`` that is ``pct`` percent of it or more."""
    near = f"CAST(ceil({x} * {pct!r}D / 100D) AS BIGINT)"

    def enough(step: str) -> str:
        return f"({step}) * 100D / {x} >= {pct!r}D"

    return (f"CASE WHEN {x} = 0 THEN 1L WHEN {near} > 1 AND {enough(near + ' - 1')} THEN {near} - 1"
            f" WHEN {near} > 0 AND {enough(near)} THEN {near} ELSE {near} + 1 END")


def _first_from(held: DataFrame, asked: DataFrame) -> DataFrame:
    """``asked(fd_id, _at, at)`` -> ``fd_id, at, to``: the ``_value`` of the first of
    ``held(fd_id, _at, _value)`` from ``_at`` on; NULL behind the last."""
    both = held.selectExpr("fd_id", "_at", "1 AS _kind", "_value", "CAST(NULL AS BIGINT) AS at").unionByName(
        asked.selectExpr("fd_id", "_at", "0 AS _kind", "CAST(NULL AS BIGINT) AS _value", "at"))
    found = scan(both, ["fd_id"], ["_at", "_kind"], {"to": Running("next", "_value")})
    return found.filter("_kind = 0").select("fd_id", "at", "to")


def _next_kept(points: DataFrame, pct: float) -> DataFrame:
    """``fd_id, at, to``: the row kept after each row, if that row is kept; by lookups of
    the least IAT and the least footprint that are far enough away.

    Footprints must not fall along a descriptor.
    """
    by_t = _first_from(
        points.selectExpr("fd_id", "delta_t AS _at", "delta_t AS _value"),
        points.selectExpr("fd_id", f"delta_t + {_least_step('delta_t', pct)} AS _at", "delta_t AS at"))
    by_mb = _first_from(
        points.groupBy("fd_id", F.col("mb").alias("_at")).agg(*aggregates({"_value": "min(delta_t)"})),
        points.selectExpr("fd_id", f"mb + {_least_step('mb', pct)} AS _at", "delta_t AS at"))
    return by_t.unionByName(by_mb).groupBy("fd_id", "at").agg(*aggregates({"to": "min(to)"}))


#: Steps that a pointer grows by in a round.
_STEPS = 4


def _followed(pointers: DataFrame) -> DataFrame:
    """``fd_id, delta_t`` of the rows that the pointers lead to from each first row.

    In every round a row's pointer becomes that of the row ``_STEPS`` pointers on.  The ways
    of all rows soon run together, so only rows that are still pointed to are carried on,
    and the tables of later rounds are short.  Backwards through the rounds, each table
    then tells the rows between those found.
    """
    heads = materialize(pointers.groupBy("fd_id").agg(*aggregates({"at": "min(at)"})), "heads")
    now = materialize(pointers.filter("to IS NOT NULL"), "pointers")
    rounds = []
    while not now.join(heads, ["fd_id", "at"], "left_semi").isEmpty():
        rounds.append(now)
        used = now.selectExpr("fd_id", "to AS at").unionByName(heads).distinct()
        onward = now.selectExpr("fd_id", "at AS to", "to AS onward")
        far = now.join(used, ["fd_id", "at"], "left_semi")
        for _ in range(_STEPS - 1):
            far = far.join(onward, ["fd_id", "to"]).selectExpr("fd_id", "at", "onward AS to")
        now = materialize(far, "pointers")
    found = heads
    for table in reversed(rounds):
        every, part = found, found
        for _ in range(_STEPS - 1):
            part = part.join(table, ["fd_id", "at"]).selectExpr("fd_id", "to AS at")
            every = every.unionByName(part)
        found = materialize(every, "kept")
    return found.withColumnRenamed("at", "delta_t")


def _falling(rows: DataFrame) -> DataFrame:
    """Descriptors whose footprint falls somewhere."""
    if "prev_mb" not in rows.columns:
        rows = scan(rows.select("fd_id", "delta_t", "mb"), ["fd_id"], ["delta_t"],
                    {"prev_mb": Running("lag", "mb")})
    return rows.filter("mb < prev_mb").select("fd_id").distinct()


def _visited(points: DataFrame, pct: float) -> DataFrame:
    """The rows kept of descriptors whose footprint falls: there the next kept row isn't the
    first above a threshold, so the points are visited in their order, as a stream of which
    a task holds one batch."""

    def visit(batches):
        import pyarrow as pa

        name, t, mb = None, None, None
        for batch in batches:
            keep = []
            for i, (fd, x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)))):
                if fd != name:
                    far = True
                else:
                    far = any(new != old if old == 0 else abs((new - old) * 100.0 / old) >= pct
                              for new, old in ((x, t), (y, mb)))
                if far:
                    name, t, mb = fd, x, y
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    sorted_points = points.repartition("fd_id").sortWithinPartitions("fd_id", "delta_t")
    return sorted_points.mapInArrow(visit, "fd_id string, delta_t bigint")


def _kept(rows: DataFrame, pct: float) -> DataFrame:
    points = rows.select("fd_id", "delta_t", "mb")
    if pct > 100:  # nothing is far enough from a start that counts as 100 percent
        return points.select("fd_id", "delta_t").limit(0)
    falling = materialize(_falling(rows), "falling")
    if falling.isEmpty():
        return _followed(_next_kept(points, pct))
    kept = _followed(_next_kept(points.join(falling, "fd_id", "left_anti"), pct))
    return kept.unionByName(_visited(points.join(falling, "fd_id", "left_semi"), pct))


def thin(rows: DataFrame, pct: float) -> DataFrame:
    """Rows that differ from the last kept row by at least ``pct`` percent in IAT or
    footprint; the traffic of the rows between goes to the next kept row.  What is
    left at the end goes to the descriptor's last row if it has any requests.

    Whether a row is kept depends on the row kept before it.  Every row finds the row that
    would be kept after it, and the pointers are followed by doubling, so no descriptor is
    one task; the traffic is then handed out segment by segment.
    """
    if pct <= 0:
        return rows.select(ROW_COLS)
    kept = _kept(rows, float(pct))
    rows = rows.select(ROW_COLS)
    marked = rows.join(kept.selectExpr("*", "true AS _kept"), ["fd_id", "delta_t"], "left")
    ended = (
        scan(marked, ["fd_id"], ["delta_t"], {"_end": Running("next", "if(_kept, delta_t, NULL)")})
        .groupBy("fd_id", "_end")
        .agg(
            *aggregates({
                "last_t": "max(delta_t)",
                "mb": "max_by(mb, delta_t)",
                "objcount": "max_by(objcount, delta_t)",
                **sums(TRAFFIC_COLS),
            })
        )
        .withColumnRenamed("last_t", "delta_t")
    )
    # a tail at IAT 0 cannot be told from the start of the axis
    return ended.filter("_end IS NOT NULL OR (requests > 0 AND delta_t <> 0)").select(ROW_COLS)
