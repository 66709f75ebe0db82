"""Joint hits of classes that share one cache, without building their mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spoor.functions.numeric import aggregates, sums
from spoor.model import Descriptors
from spoor.operators.lookup import markers
from spoor.operators.scan import Running, scan
from spoor.operators.transform import linked
from spoor.session import materialize

RESULT_COLS = ["mix_id", "cache_mb", "hit_bytes", "served_bytes", "iat"]


def _bounds(d: Descriptors, cache_mb: int, marker_mb: list[int] | None) -> DataFrame:
    """Per class the IAT of the marker and that of half the cache, in one pass.

    A list of further markers only matters where several of them lie between the
    footprints of two rows and so push each other to later rows.
    """
    known = sorted(set([cache_mb] if marker_mb is None else marker_mb))
    if cache_mb not in known:
        raise ValueError(f"no marker for a cache of {cache_mb} mb")
    own = d.rows.groupBy("fd_id").agg(
        *aggregates({
            "marker_t": f"coalesce(min(if(mb > {cache_mb}, delta_t, NULL)), max(delta_t))",
            "half_t": f"coalesce(max(if(mb <= {cache_mb // 2}, delta_t, NULL)), min(delta_t))",
        })
    )
    if len(known) == 1:
        return own
    crowded = markers(d.rows, known).filter(F.col("marker_mb") == cache_mb)
    return own.drop("marker_t").join(
        crowded.select("fd_id", F.col("delta_t").alias("marker_t")), "fd_id"
    )


def quick_lookup(
    d: Descriptors, cache_mb: int, marker_mb: list[int] | None = None
) -> DataFrame:
    """Hit bytes of each class alone in a cache of ``cache_mb``."""
    return _alone(d, _bounds(d, cache_mb, marker_mb), cache_mb)


def _alone(d: Descriptors, bounds: DataFrame, cache_mb: int) -> DataFrame:
    hits = (
        d.rows.select("fd_id", "delta_t", "bytes")
        .join(bounds.select("fd_id", "marker_t"), "fd_id")
        .filter("delta_t <= marker_t")
        .groupBy("fd_id")
        .agg(F.sum("bytes").alias("cum_bytes"), F.max("marker_t").alias("iat"))
    )
    return hits.join(
        d.headers.select("fd_id", "total_served_bytes", "total_mib"), "fd_id"
    ).select(
        "fd_id",
        F.lit(cache_mb).cast("bigint").alias("cache_mb"),
        (F.col("cum_bytes") - F.col("total_mib")).alias("hit_bytes"),
        F.col("total_served_bytes").alias("served_bytes"),
        "iat",
    )


def quick_add(
    groups: DataFrame, d: Descriptors, cache_mb: int, marker_mb: list[int] | None = None
) -> DataFrame:
    """Groups ``(mix_id, fd_id)`` -> hits when the classes of a group share a cache.

    The classes' joint footprint grows with the IAT; the answer is the hit volume
    at the largest IAT where it still fits.  The search range of a group runs from
    the smallest IAT at which a class fills half the cache to the smallest at which
    one outgrows it.  A group with one class that has traffic is looked up directly.
    """
    of_mix = Window.partitionBy("mix_id")
    # small next to the rows and read several times: stored, so that its size is known
    live = materialize(
        groups.join(
            d.headers.filter("total_requests <> 0").select(
                "fd_id", "total_served_bytes", "total_mib"
            ),
            "fd_id",
        )
        .join(_bounds(d, cache_mb, marker_mb), "fd_id")
        .withColumn("n_members", F.count("*").over(of_mix)),
        "sharers",
    )
    bounds = live.groupBy("mix_id").agg(
        F.max("n_members").alias("n_members"),
        F.sum("total_served_bytes").alias("served_bytes"),
        F.sum("total_mib").alias("mib"),
        F.min("half_t").alias("left_t"),
        F.min("marker_t").alias("right_t"),
    )
    shared = live.filter("n_members > 1")
    amounts = ["mb_base", "mb_step", "bytes_base", "bytes_step"]
    steps = (
        linked(d.rows)
        .join(shared.select("mix_id", "fd_id"), "fd_id")
        .selectExpr(
            "mix_id",
            "delta_t",
            "if(prev_mb IS NULL, mb, 0L) AS mb_base",
            "if(prev_mb IS NULL, 0L, mb - prev_mb) AS mb_step",
            "if(prev_mb IS NULL, bytes, 0L) AS bytes_base",
            "if(prev_mb IS NULL, 0L, bytes) AS bytes_step",
        )
    )
    start = bounds.filter("n_members > 1").selectExpr(
        "mix_id", "left_t AS delta_t", *[f"0L AS {c}" for c in amounts]
    )
    grid = steps.unionByName(start).groupBy("mix_id", "delta_t").agg(*aggregates(sums(amounts)))
    swept = scan(
        grid,
        ["mix_id"],
        ["delta_t"],
        {
            "_mb": Running("sum", "mb_step"),
            "_bytes": Running("sum", "bytes_step"),
            "_mb0": Running("total", "mb_base"),
            "_bytes0": Running("total", "bytes_base"),
            "_next": Running("lead", "delta_t"),
        },
        beside=bounds,
    ).selectExpr(
        "*", f"delta_t >= left_t AND delta_t < right_t AND _mb0 + _mb <= {cache_mb} AS fits"
    )
    # a point that fits wins over the left end, which stands in if none does
    found = {
        "hit_bytes": "_bytes0 + _bytes - mib",
        "served_bytes": "served_bytes",
        "iat": "if(fits, least(_next, right_t) - 1, left_t)",
    }
    best = (
        swept.filter("fits OR delta_t = left_t")
        .groupBy("mix_id")
        .agg(*aggregates({c: f"max_by({e}, if(fits, delta_t, -1L))" for c, e in found.items()}))
        .selectExpr("mix_id", f"{cache_mb}L AS cache_mb", *found)
    )
    single = live.filter("n_members = 1").select("mix_id", "fd_id", "marker_t")
    alone = (
        _alone(d, single.select("fd_id", "marker_t").distinct(), cache_mb)
        .join(single.select("mix_id", "fd_id"), "fd_id")
        .select(RESULT_COLS)
    )
    return best.select(RESULT_COLS).unionByName(alone)
