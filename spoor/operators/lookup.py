"""Lookups on descriptors and curves.

Probes come as a DataFrame, any number per descriptor.  They are merged into the
axis with the rows and answered by one running value, so neither a range join nor
a rows-times-probes product occurs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spoor.functions.numeric import aggregates, percent
from spoor.model import TRAFFIC_COLS
from spoor.operators.curves import Quota
from spoor.operators.scan import Running, scan

_PAYLOAD = ["mb", "objcount", *TRAFFIC_COLS]


def _answer(
    probes: DataFrame, probe: str, look_up: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Looks up every distinct ``(fd_id, probe)`` once and gives the answer to all probes
    that ask for it, so a value that is asked very often is no hot spot."""
    asked = probes.withColumn(probe, probes[probe].cast("bigint"))
    return asked.join(look_up(asked.select("fd_id", probe).distinct()), ["fd_id", probe])


def _merged(held: DataFrame, asked: DataFrame, probe: str, wanted: dict[str, Running]):
    """The ``wanted`` running values of the ``held`` rows, ordered by ``_at``, at each probe."""
    points = asked.selectExpr("fd_id", f"{probe} AS _at", "1 AS _kind")
    both = held.selectExpr("*", "0 AS _kind").unionByName(points, allowMissingColumns=True)
    return scan(both, ["fd_id"], ["_at", "_kind"], wanted).filter("_kind = 1")


def _floor_join(
    rows: DataFrame, probes: DataFrame, axis: str, probe: str, payload: list[str]
) -> DataFrame:
    """For each probe the payload of the row with the largest ``axis`` <= ``probe``;
    before the first row that row itself."""
    columns = [axis, *payload]
    held = rows.selectExpr("fd_id", f"{axis} AS _at", *[f"{c} AS _{c}" for c in columns])
    # column by column: numbers are aggregated by hashing, structs would be sorted
    wanted = {f"_last_{c}": Running("last", f"_{c}") for c in columns}
    wanted |= {f"_head_{c}": Running("first", f"_{c}") for c in columns}

    def look_up(asked: DataFrame) -> DataFrame:
        found = _merged(held, asked, probe, wanted).filter(f"_head_{axis} IS NOT NULL")
        return found.selectExpr(
            "fd_id",
            f"_at AS {probe}",
            *[f"coalesce(_last_{c}, _head_{c}) AS {c}" for c in columns],
        )

    return _answer(probes, probe, look_up)


def _best_below(
    rows: DataFrame, probes: DataFrame, axis: str, probe: str, answer: str
) -> DataFrame:
    """Per probe the largest ``answer`` among the rows with ``axis`` <= ``probe``,
    the descriptor's smallest ``answer`` if there is none."""
    held = (
        rows.groupBy("fd_id", axis)
        .agg(*aggregates({"_best": f"max({answer})", "_worst": f"min({answer})"}))
        .withColumnRenamed(axis, "_at")
    )
    wanted = {"_found": Running("max", "_best"), "_floor": Running("least", "_worst")}

    def look_up(asked: DataFrame) -> DataFrame:
        return _merged(held, asked, probe, wanted).filter("_floor IS NOT NULL").selectExpr(
            "fd_id", f"_at AS {probe}", f"coalesce(_found, _floor) AS {answer}"
        )

    return _answer(probes, probe, look_up)


# ---------------------------------------------------------------- by IAT


def asof(rows: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes ``(fd_id, t)`` -> the row at the largest ``delta_t`` <= t, else the first row."""
    return _floor_join(rows, probes, "delta_t", "t", _PAYLOAD)


def matching(rows: DataFrame, probes: DataFrame) -> DataFrame:
    """As :func:`asof`, with the traffic set to 0 unless the IAT matches exactly."""
    return _exact_traffic(asof(rows, probes))


def _exact_traffic(found: DataFrame) -> DataFrame:
    return found.selectExpr(
        *[f"if(t = delta_t, {c}, 0L) AS {c}" if c in TRAFFIC_COLS else c for c in found.columns]
    )


def stack_distance(rows: DataFrame, probes: DataFrame, quota: Quota | None = None,
                   unset_is_zero: bool = False) -> DataFrame:
    """Probes ``(fd_id, t)`` -> footprint (mb) at that IAT, within a quota if given."""
    found = asof(rows, probes) if quota is None else asof_within(rows, probes, quota,
                                                                 unset_is_zero)
    return found.select("fd_id", "t", "mb")


def asof_within(
    rows: DataFrame, probes: DataFrame, quota: Quota, unset_is_zero: bool = False
) -> DataFrame:
    """As-of lookup that first goes back to a row within the maxima (else the first
    row), then forward to a row that reaches the minima (else the last row).

    An unset limit admits everything; with ``unset_is_zero`` an unset limit next to
    a set one of the same side counts as a limit of 0.
    """
    upper = _limits("<=", quota.max_mb, quota.max_count, unset_is_zero)
    lower = _limits(">=", quota.min_mb, quota.min_count, unset_is_zero)
    if upper is None and lower is None:
        return asof(rows, probes)
    columns = ["delta_t", *_PAYLOAD]
    held = rows.select("fd_id", *columns)
    if lower is None:
        ends = {c: c for c in columns}
    else:
        # where the walk forward from each row ends
        held = scan(held, ["fd_id"], ["delta_t"], {
            **{f"_ahead_{c}": Running("next", f"if({lower}, {c}, NULL)") for c in columns},
            **{f"_tail_{c}": Running("final", c) for c in columns}})
        ends = {c: f"coalesce(_ahead_{c}, _tail_{c})" for c in columns}
    held = held.selectExpr("fd_id", "delta_t AS _at", f"{upper or 'true'} AS _within",
                           *[f"{e} AS _{c}" for c, e in ends.items()])
    wanted = {f"_last_{c}": Running("last", f"if(_within, _{c}, NULL)") for c in columns}
    wanted |= {f"_head_{c}": Running("first", f"_{c}") for c in columns}

    def look_up(asked: DataFrame) -> DataFrame:
        found = _merged(held, asked, "t", wanted).filter("_head_delta_t IS NOT NULL")
        return found.selectExpr("fd_id", "_at AS t", *[
            f"coalesce(_last_{c}, _head_{c}) AS {c}" for c in columns])

    return _answer(probes, "t", look_up)


def matching_within(
    rows: DataFrame, probes: DataFrame, quota: Quota, unset_is_zero: bool = False
) -> DataFrame:
    return _exact_traffic(asof_within(rows, probes, quota, unset_is_zero))


def _limits(sign: str, mb: int, count: int, unset_is_zero: bool) -> str | None:
    if mb == 0 and count == 0:
        return None
    given = [("mb", mb), ("objcount", count)]
    return " AND ".join(f"{c} {sign} {v}" for c, v in given if v or unset_is_zero)


# ---------------------------------------------------------------- by footprint


def iat_for_mb(rows: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes ``(fd_id, target_mb)`` -> the largest IAT whose footprint does not exceed
    it, the first IAT if all do."""
    return _best_below(rows, probes, "mb", "target_mb", "delta_t")


def iats_with_mb(rows: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes ``(fd_id, mb)`` -> every IAT with exactly that footprint."""
    return rows.join(probes.select("fd_id", "mb").distinct(), ["fd_id", "mb"]).select(
        "fd_id", "mb", "delta_t"
    )


#: Buckets of a stored index: as many tasks read it at most.
INDEX_BUCKETS = 64


def store_iat_index(rows: DataFrame, name: str, path: str, buckets: int = INDEX_BUCKETS) -> None:
    """Store the IATs by footprint as table ``name`` below ``path``, bucketed and sorted by
    class and footprint.  Lookups then read the buckets they need and leave the rows where
    they are, however many lookups follow."""
    spark = rows.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (
        rows.select("fd_id", "mb", "delta_t")
        .repartition(buckets, "fd_id", "mb")
        .write.bucketBy(buckets, "fd_id", "mb").sortBy("fd_id", "mb")
        .option("path", path).saveAsTable(name)
    )


def iats_in_index(spark: SparkSession, name: str, probes: DataFrame) -> DataFrame:
    """Probes ``(fd_id, mb)`` -> every IAT with exactly that footprint, from the stored
    index: only the probes are dealt out, to the buckets."""
    asked = probes.select("fd_id", "mb").distinct()
    return spark.table(name).join(asked.hint("merge"), ["fd_id", "mb"]).select("fd_id", "mb", "delta_t")


def stack_distances(rows: DataFrame) -> DataFrame:
    """The distinct footprints of each descriptor."""
    return rows.select("fd_id", "mb").distinct()


def markers(rows: DataFrame, marker_mb: list[int]) -> DataFrame:
    """Cache sizes -> IAT for every descriptor.

    In ascending order, a size takes the first row whose footprint exceeds it and
    that lies after the row of the size before; sizes left over take the last row.
    The marker list is a parameter, so only ``len(marker_mb)`` row numbers per
    descriptor are found; no rows are collected.
    """
    sizes = sorted({int(c) for c in marker_mb})
    if len(sizes) == 1:
        above = f"min(if(mb > {sizes[0]}, delta_t, NULL))"
        return rows.groupBy("fd_id").agg(
            *aggregates({"marker_mb": f"CAST({sizes[0]} AS BIGINT)",
                         "delta_t": f"coalesce({above}, max(delta_t))"})
        )
    ranked = scan(
        rows.select("fd_id", "delta_t", "mb"),
        ["fd_id"],
        ["delta_t"],
        {"_n": Running("sum", "1L")},
    )
    # row number of the first row above each size
    firsts = ranked.groupBy("fd_id").agg(
        *aggregates({"_rows": "max(_n)", **{f"_f{j}": f"min(if(mb > {c}, _n, NULL))"
                                            for j, c in enumerate(sizes)}})
    )
    # each size needs a row of its own: the (j-i)-th row after that of size i at least
    picks = []
    for j, c in enumerate(sizes):
        reach = ", ".join(["0L", *[f"_f{i} + {j - i}" for i in range(j + 1)]])
        picks.append(
            f"named_struct('marker_mb', {c}L, '_n', least(coalesce("
            f"if(_f{j} IS NOT NULL, greatest({reach}), NULL), _rows), _rows))"
        )
    wanted = firsts.selectExpr("fd_id", f"inline(array({', '.join(picks)}))")
    return wanted.join(ranked.select("fd_id", "_n", "delta_t"), ["fd_id", "_n"]).select(
        "fd_id", "marker_mb", "delta_t"
    )


# ---------------------------------------------------------------- cumulative


def with_cum_bytes(rows: DataFrame) -> DataFrame:
    """``rows`` plus the running sum of bytes along the IAT axis."""
    return scan(rows, ["fd_id"], ["delta_t"], {"cum_bytes": Running("sum", "bytes")})


# ---------------------------------------------------------------- on curves


def curve_lookup(curve: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes ``(fd_id, cache_mb)`` -> the space curve's point at the largest size <= it."""
    return _floor_join(curve, probes, "mb", "cache_mb", ["requests", "bytes"])


def count_lookup(curve: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes ``(fd_id, cache_objects)`` -> the count curve's point."""
    return _floor_join(curve, probes, "objcount", "cache_objects", ["requests", "bytes"])


def hit_rate_at(curve: DataFrame, headers: DataFrame, probes: DataFrame) -> DataFrame:
    """Byte hit rate (%) at a cache size."""
    found = curve_lookup(curve, probes)
    return found.join(headers.select("fd_id", "total_served_bytes"), "fd_id").selectExpr(
        "fd_id", "cache_mb", f"{percent('bytes', 'total_served_bytes')} AS byte_hit_pct"
    )


def size_for_hit_rate(curve: DataFrame, headers: DataFrame, probes: DataFrame) -> DataFrame:
    """Probes ``(fd_id, hit_pct)`` -> the largest size whose hit bytes stay within that
    share of the served bytes; the first size if none does."""
    wanted = probes.join(headers.select("fd_id", "total_served_bytes"), "fd_id").selectExpr(
        "fd_id",
        "hit_pct",
        "CAST(total_served_bytes * hit_pct / 100D AS BIGINT) AS _hit_bytes",
    )
    points = curve.selectExpr("fd_id", "mb", "bytes AS _bytes")
    return _best_below(points, wanted, "_bytes", "_hit_bytes", "mb").select(
        "fd_id", "hit_pct", "mb"
    )
