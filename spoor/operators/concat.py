"""Concatenation: descriptors side by side, each class in a cache of its own.

For every footprint that occurs in a member, the members' IATs are averaged and
their caches added up.  The averages are kept as running sums of steps along the
footprint axis, so the work is linear in the rows, not members times footprints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.functions.numeric import aggregates, int_div, sums, times
from spoor.model import HEADER_COLS, ROW_COLS, TRAFFIC_COLS, UNIQUE_COLS, VOLUME_COLS, Descriptors
from spoor.operators.scan import Running, scan
from spoor.operators.transform import changed
from spoor.session import materialize

_WIDE = "DECIMAL(38, 0)"


def read_scaled(
    rules: DataFrame, d: Descriptors, compat_float32: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Members of complete concat rule sets, scaled the way a scaled read does it:
    traffic and IATs are multiplied, rows on one IAT add up, the last footprint counts.

    Returns headers and rows keyed by ``(concat_id, ord)``.  A rule set with a member
    that does not exist, or with a scale of 0, is left out as a whole.
    """
    absent = rules.join(d.headers.select("fd_id"), "fd_id", "left_anti").select("concat_id")
    broken = absent.unionByName(rules.filter("scale = 0").select("concat_id")).distinct()
    complete = rules.join(broken, "concat_id", "left_anti")

    def scaled(c: str) -> str:
        return times(c, "scale", compat_float32)

    headers = changed(
        complete.join(d.headers, "fd_id"),
        ["concat_id", "ord", "fd_id", "scale", *HEADER_COLS[1:]],
        dict.fromkeys(VOLUME_COLS, scaled),
    )
    rows = (
        d.rows.select(ROW_COLS)
        .join(complete, "fd_id")
        .selectExpr(
            "concat_id",
            "ord",
            "delta_t AS _old_t",
            "mb",
            "objcount",
            *[f"{scaled(c)} AS {c}" for c in ["delta_t", *TRAFFIC_COLS]],
        )
        .groupBy("concat_id", "ord", "delta_t")
        .agg(*aggregates({"mb": "max_by(mb, _old_t)", "objcount": "max_by(objcount, _old_t)",
                          **sums(TRAFFIC_COLS)}))
    )
    return headers, rows


def concat_headers(headers: DataFrame, min_ghost: int = 1) -> DataFrame:
    """Totals of the scaled member ``headers`` per ``concat_id``."""
    shared = {c: int_div(f"sum({c})", max(min_ghost, 1)) for c in UNIQUE_COLS}
    return (
        headers.groupBy(F.col("concat_id").alias("fd_id"))
        .agg(*aggregates({**sums(VOLUME_COLS), "duration": "max(duration)", **shared}))
        .select(HEADER_COLS)
    )


def concat(
    rules: DataFrame,
    d: Descriptors,
    weigh_by_traffic: bool = False,
    cmax: int = 0,
    min_ghost: int = 1,
    compat_float32: bool = False,
) -> Descriptors:
    """All concat rule sets ``(concat_id, ord, fd_id, scale)``; the result's ``fd_id`` is
    the ``concat_id``.  Members' footprints above ``cmax`` mb, the cache of one machine,
    are left out (0: no limit); :func:`above_limit` tells how much that is."""
    headers, rows = read_scaled(rules, d, compat_float32)
    return Descriptors(
        concat_headers(headers, min_ghost), _concat_rows(headers, rows, weigh_by_traffic, cmax)
    )


def above_limit(
    rules: DataFrame, d: Descriptors, cmax: int, compat_float32: bool = False
) -> DataFrame:
    """Rows and bytes per ``concat_id`` that a limit of ``cmax`` mb leaves out."""
    _, rows = read_scaled(rules, d, compat_float32)
    return rows.filter(f"mb > {cmax}").groupBy("concat_id").agg(
        *aggregates({"rows": "count(*)", "bytes": "sum(bytes + tr_bytes)"})
    )


def _concat_rows(
    headers: DataFrame, rows: DataFrame, weigh_by_traffic: bool, cmax: int
) -> DataFrame:
    heads = headers.selectExpr(
        "concat_id",
        "ord",
        f"CAST({'total_served_bytes' if weigh_by_traffic else 1} AS {_WIDE}) AS w",
        "count(*) OVER (PARTITION BY concat_id) AS n",
    )
    at_size = materialize(
        rows.groupBy("concat_id", "ord", "mb")
        .agg(*aggregates({"t_sum": "sum(delta_t)", "t_count": "count(*)", **sums(TRAFFIC_COLS)}))
        .selectExpr("*", "t_sum div t_count AS t_mean"),
        "concat-sizes",
    )
    placed = scan(
        at_size,
        ["concat_id", "ord"],
        ["mb"],
        {"prev_mean": Running("lag", "t_mean"), "next_mb": Running("lead", "mb")},
        beside=heads,
    )
    if cmax > 0:
        placed = placed.filter(f"mb <= {cmax}")
    # what a member adds where one of its footprints lies: to the sum of the mean IATs,
    # to the weights (at its first), to the members past their last footprint
    parts = placed.selectExpr(
        "concat_id",
        "mb",
        "n",
        f"CAST((t_mean - coalesce(prev_mean, 0L)) * w AS {_WIDE}) AS mean_step",
        f"if(prev_mean IS NULL, w, CAST(0 AS {_WIDE})) AS w_step",
        "CAST(w AS DOUBLE) * (t_sum - t_mean * t_count) / t_count AS fraction",
        "if(next_mb IS NULL, 1L, 0L) AS ending",
        "if(next_mb IS NULL, mb, 0L) AS ending_mb",
        *TRAFFIC_COLS,
    )
    wide = {c: f"CAST(sum({c}) AS {_WIDE})" for c in ("mean_step", "w_step")}
    grid = parts.groupBy("concat_id", "mb").agg(
        *aggregates({"n": "max(n)", **wide,
                     **sums(["fraction", "ending", "ending_mb", *TRAFFIC_COLS])})
    )
    swept = scan(
        grid,
        ["concat_id"],
        ["mb"],
        {
            "weighted": Running("sum", "mean_step"),
            "weights": Running("sum", "w_step"),
            "ended": Running("sum", "ending"),
            "ended_mb": Running("sum", "ending_mb"),
        },
        source=parts,
    )
    mean = "CAST((CAST(weighted AS DOUBLE) + fraction) / CAST(weights AS DOUBLE) AS BIGINT)"
    return (
        swept.selectExpr(
            "concat_id AS fd_id",
            f"if(weights > 0, {mean}, 0L) AS delta_t",
            "mb AS _size",
            "mb * (n - (ended - ending)) + ended_mb - ending_mb AS mb",
            *TRAFFIC_COLS,
        )
        .groupBy("fd_id", "delta_t")
        .agg(*aggregates({"mb": "max_by(mb, _size)", "objcount": "0L", **sums(TRAFFIC_COLS)}))
        .select(ROW_COLS)
    )
