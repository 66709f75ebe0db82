"""Hit-rate curves: cumulative hits by cache size (mb) or by object count."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from spoor.functions.numeric import aggregates, named, percent
from spoor.model import Descriptors
from spoor.operators.scan import Running, scan


@dataclass(frozen=True)
class Quota:
    """Limits on footprint and object count; 0 means no limit."""

    max_mb: int = 0
    min_mb: int = 0
    max_count: int = 0
    min_count: int = 0

    def admits(self) -> str:
        limits = [
            ("mb <= {}", self.max_mb),
            ("mb >= {}", self.min_mb),
            ("objcount <= {}", self.max_count),
            ("objcount >= {}", self.min_count),
        ]
        return " AND ".join(["true", *[text.format(v) for text, v in limits if v > 0]])


def within_quota(rows: DataFrame, quota: Quota) -> DataFrame:
    return rows.filter(quota.admits())


def _curve(d: Descriptors, axis: str, include_transitions: bool, quota: Quota) -> DataFrame:
    extra = {"requests": " + tr_requests", "bytes": " + tr_bytes"} if include_transitions else {}
    at_size = (
        within_quota(d.rows, quota)
        .groupBy("fd_id", axis)
        .agg(*aggregates({c: f"sum({c}{extra.get(c, '')})" for c in ("requests", "bytes")}))
    )
    running = scan(
        at_size,
        ["fd_id"],
        [axis],
        {"hit_requests": Running("sum", "requests"), "hit_bytes": Running("sum", "bytes")},
        beside=d.headers.select("fd_id", "total_requests", "total_served_bytes", "total_mib"),
    )
    hit = "hit_bytes - total_mib"
    return running.selectExpr(
        "fd_id",
        axis,
        *named({
            "requests": "hit_requests",
            "request_pct": percent("hit_requests", "total_requests"),
            "bytes": hit,
            "byte_pct": percent(hit, "total_served_bytes"),
        }),
    )


def space_curve(
    d: Descriptors, include_transitions: bool = False, quota: Quota = Quota()
) -> DataFrame:
    """Cache size -> cumulative hit requests and bytes."""
    return _curve(d, "mb", include_transitions, quota)


def count_curve(
    d: Descriptors, include_transitions: bool = False, quota: Quota = Quota()
) -> DataFrame:
    """Number of cached objects -> cumulative hit requests and bytes."""
    return _curve(d, "objcount", include_transitions, quota)


def max_hit_rate(curve: DataFrame, headers: DataFrame) -> DataFrame:
    """Byte hit rate (%) at the largest size of each space curve, 0 without traffic."""
    top = curve.groupBy("fd_id").agg(*aggregates({"bytes": "max_by(bytes, mb)"}))
    rate = percent("bytes", "total_served_bytes")
    return top.join(headers.select("fd_id", "total_served_bytes"), "fd_id").selectExpr(
        "fd_id", f"if(total_served_bytes > 0, {rate}, 0D) AS max_hit_rate"
    )
