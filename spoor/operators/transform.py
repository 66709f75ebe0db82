"""Per-descriptor transforms: scale, shard, unshard, stretch, split.

Every transform is a projection over all descriptors at once.  Transforms that
move rows along the IAT axis keep their order, so neighbours computed once by
:func:`linked` tell which rows fall on the same new IAT without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from spoor.functions.numeric import aggregates, int_div, named, over, sums, times
from spoor.model import (
    HEADER_COLS,
    LINK_COLS,
    ROW_COLS,
    TRAFFIC_COLS,
    UNIQUE_COLS,
    VOLUME_COLS,
    Descriptors,
)
from spoor.operators.scan import Running, scan


def linked(rows: DataFrame) -> DataFrame:
    """``rows`` plus the neighbouring values of each row; a table that carries
    them already is returned as it is, so they are best stored with it."""
    if set(LINK_COLS) <= set(rows.columns):
        return rows
    return scan(
        rows.select(ROW_COLS),
        ["fd_id"],
        ["delta_t"],
        {
            "prev_mb": Running("lag", "mb"),
            "prev_objcount": Running("lag", "objcount"),
            "next_delta_t": Running("lead", "delta_t"),
            "first_delta_t": Running("first", "delta_t"),
        },
    )


def changed(df: DataFrame, columns: list[str], change: dict[str, Callable[[str], str]]):
    """``columns`` of ``df``, some of them replaced by an expression of themselves."""
    return df.selectExpr(*[f"{change[c](c)} AS {c}" if c in change else c for c in columns])


def scaled_iat(delta_t: str, factor: str) -> str:
    return f"CAST({delta_t} / abs({factor}) AS BIGINT)"


def merge_collisions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per IAT: largest footprint, traffic added up."""
    return rows.groupBy(*keys, "delta_t").agg(
        *aggregates({"mb": "max(mb)", "objcount": "max(objcount)", **sums(TRAFFIC_COLS)})
    )


def _scale_header(headers: DataFrame, factor: str) -> DataFrame:
    return changed(headers, HEADER_COLS, dict.fromkeys(VOLUME_COLS, lambda c: times(c, factor)))


def _scale_rows(rows: DataFrame, factor: str, collision: str) -> DataFrame:
    """``rows`` has to be linked for ``collision='last'``."""
    new_t = scaled_iat("delta_t", factor)
    if collision == "last":
        next_t = scaled_iat("next_delta_t", factor)
        rows = rows.filter(f"next_delta_t IS NULL OR {next_t} <> {new_t}")
    elif collision != "merge":
        raise ValueError(f"unknown collision rule {collision!r}")
    change = dict.fromkeys(TRAFFIC_COLS, lambda c: times(c, factor))
    moved = changed(rows, ROW_COLS, {**change, "delta_t": lambda _: new_t})
    return moved if collision == "last" else merge_collisions(moved, ["fd_id"])


def real(value: float, single: bool = False) -> str:
    """A number as a SQL literal, rounded to single precision if asked."""
    literal = f"CAST({float(value)!r} AS DOUBLE)"
    return f"CAST(CAST({literal} AS FLOAT) AS DOUBLE)" if single else literal


def scale(
    d: Descriptors, factor: float, collision: str = "last", compat_float32: bool = False
) -> Descriptors:
    """Multiply the traffic by ``factor``; IATs shrink by its absolute value.

    Where several rows fall on one new IAT, ``collision='last'`` keeps the row of
    the largest old IAT, ``'merge'`` adds their traffic up.
    """
    if factor == 0:
        raise ValueError("a scale of 0 is not defined")
    f = real(factor, compat_float32)
    rows = linked(d.rows) if collision == "last" else d.rows
    return Descriptors(_scale_header(d.headers, f), _scale_rows(rows, f, collision))


def traffic_factor(target_bps: str, served_bytes: str, duration: str) -> str:
    """Factor that brings a class to ``target_bps`` bits/s; NULL if it has no rate."""
    rate = int_div(f"{served_bytes} * 8", duration)
    return f"{target_bps} / nullif(CAST({rate} AS DOUBLE), 0D)"


def scale_to_traffic(d: Descriptors, target_bps: float, collision: str = "last") -> Descriptors:
    """Scale every descriptor to ``target_bps`` bits/s; those without a rate drop out."""
    factor = traffic_factor(real(target_bps), "total_served_bytes", "duration")
    heads = d.headers.selectExpr("*", f"{factor} AS _factor").filter("_factor <> 0")
    rows = linked(d.rows) if collision == "last" else d.rows
    rows = rows.join(heads.select("fd_id", "_factor"), "fd_id")
    return Descriptors(_scale_header(heads, "_factor"), _scale_rows(rows, "_factor", collision))


def without_rate(d: Descriptors, duration_only: bool = False) -> DataFrame:
    """The descriptors that :func:`scale_to_traffic` (or, with ``duration_only``,
    :func:`stretch_duration`) leaves out, with a ``reason``."""
    reason = "CASE WHEN duration = 0 THEN 'duration 0'"
    if not duration_only:
        reason += " WHEN coalesce(total_served_bytes * 8 div duration, 0) = 0 THEN 'no rate'"
    return d.headers.selectExpr("fd_id", f"{reason} END AS reason").filter("reason IS NOT NULL")


def _each(d: Descriptors, change: Callable[[str], str]) -> Descriptors:
    amounts = dict.fromkeys([*VOLUME_COLS, *UNIQUE_COLS, *ROW_COLS[2:]], change)
    return Descriptors(
        changed(d.headers, HEADER_COLS, amounts), changed(d.rows, ROW_COLS, amounts)
    )


def shard(d: Descriptors, n: float, compat_float32: bool = False) -> Descriptors:
    """One of ``n`` equal shards: every amount divided, IATs kept; 0 changes nothing."""
    return _each(d, lambda c: over(c, real(n), compat_float32)) if n else d


def unshard(d: Descriptors, n: float, compat_float32: bool = False) -> Descriptors:
    """The whole of which the descriptor is one of ``n`` shards; 0 changes nothing."""
    return _each(d, lambda c: times(c, real(n), compat_float32)) if n else d


def shard_fraction(
    d: Descriptors, taken: int, total: int, compat_float32: bool = False
) -> Descriptors:
    """``taken`` of ``total`` shards, cut to integers after each of the two steps."""
    if total <= 1 or taken == total:
        return d
    one = shard(d, total, compat_float32)
    return unshard(one, taken, compat_float32) if taken > 1 else one


def stretch_duration(d: Descriptors, duration: int, compat_float32: bool = False) -> Descriptors:
    """The same class observed for another ``duration``; transitions are not stretched.
    Descriptors of duration 0 have no rate to stretch and drop out."""
    heads = d.headers.filter("duration <> 0").selectExpr(
        "*", f"{real(duration)} / duration AS _f"
    )

    def stretched(c: str) -> str:
        return times(c, "_f", compat_float32)

    change = dict.fromkeys(VOLUME_COLS, stretched)
    headers = changed(
        heads, HEADER_COLS, {**change, "duration": lambda _: f"CAST({duration} AS BIGINT)"}
    )
    rows = d.rows.join(heads.select("fd_id", "_f"), "fd_id")
    return Descriptors(
        headers, changed(rows, ROW_COLS, {"requests": stretched, "bytes": stretched})
    )


def split_virtual(d: Descriptors, n: int) -> Descriptors:
    """One of ``n`` virtual parts with 1/n of the footprint and traffic, IATs n times
    as long; unique counts are kept."""
    share = dict.fromkeys([*VOLUME_COLS, *ROW_COLS[2:]], lambda c: int_div(c, n))
    return Descriptors(
        changed(d.headers, HEADER_COLS, share),
        changed(d.rows, ROW_COLS, {**share, "delta_t": lambda c: f"{c} * {n}"}),
    )


def coalesce_rows(lines: DataFrame, order: str = "line_no") -> DataFrame:
    """One row per IAT from rows in file order: traffic adds up, the last footprint counts."""
    return lines.groupBy("fd_id", "delta_t").agg(
        *aggregates({"mb": f"max_by(mb, {order})", "objcount": f"max_by(objcount, {order})",
                     **sums(TRAFFIC_COLS)})
    )


def float32_traffic(d: Descriptors) -> Descriptors:
    """Traffic and volume counters as a single-precision reader would store them."""
    rounded = dict.fromkeys([*VOLUME_COLS, *TRAFFIC_COLS, "delta_t"],
                            lambda c: times(c, "1", True))
    return Descriptors(
        changed(d.headers, HEADER_COLS, rounded), changed(d.rows, ROW_COLS, rounded)
    )


def validity(d: Descriptors) -> DataFrame:
    """Per descriptor: has it no traffic, and is it fit to be written?"""
    bodies = d.rows.groupBy("fd_id").agg(*aggregates({"body_rows": "count(*)"}))
    return d.headers.join(bodies, "fd_id", "left").selectExpr(
        "fd_id",
        *named({
            "is_empty": "total_requests = 0",
            "is_valid": "coalesce(body_rows, 0) > 0 AND total_requests > 0"
                        " AND total_served_bytes > 0",
        }),
    )
