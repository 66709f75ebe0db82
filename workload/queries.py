"""The registered queries: one per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spoor.model import HEADER_COLS, ROW_COLS, Descriptors
from spoor.operators import accesslog, curves, lookup, mix, quickadd, summary, thin, transform
from spoor.operators.concat import concat, concat_headers, read_scaled
from spoor.session import materialize, new_path
from spoor.sources.descriptors import read_descriptors, write_descriptors, write_flat
from spoor.sources.rules import read_bundle, rules_from_customer_map
from spoor.streaming import accesslog as live
from workload import files
from workload import fixtures as fx
from workload.oracle import PARTS, THIN_PCT

Query = Callable[[SparkSession, str], DataFrame]


def _events(make) -> Query:
    return lambda spark, sf: make(fx.descriptors(spark, sf, "events"))


def _lines(make) -> Query:
    return lambda spark, sf: make(fx.descriptors(spark, sf, "lineitem"))


def _probed(make, probes) -> Query:
    """A lookup on the events descriptors with probes from the tables."""
    return lambda spark, sf: make(fx.descriptors(spark, sf, "events"), probes(spark, sf))


def _mixed(*sets, **options):
    return lambda spark, sf: mix.mix(
        fx.rules(spark, *sets), fx.descriptors(spark, sf, "events"), **options
    )


def _all_headers(spark: SparkSession, sf: str) -> DataFrame:
    return fx.descriptors(spark, sf, "events").headers.select(HEADER_COLS).unionByName(
        fx.descriptors(spark, sf, "lineitem").headers.select(HEADER_COLS)
    )


def _built(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The descriptor rows computed from the log, not the stored table."""
    log = fx.LOGS[name][0](spark, sf)
    return accesslog.rows_from_log(log, accesslog.object_totals(log)).select(ROW_COLS)


def _built_headers(spark: SparkSession, sf: str) -> DataFrame:
    parts = []
    for name, (make_log, unit) in fx.LOGS.items():
        log, rows = make_log(spark, sf), fx.descriptors(spark, sf, name).rows
        parts.append(
            accesslog.headers_from_log(log, accesslog.object_totals(log), rows, unit)
        )
    return parts[0].unionByName(parts[1])


def mixed_space_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Hits by cache size when half of every class shares one cache."""
    return curves.space_curve(_mixed(fx.HALF_ALL)(spark, sf))


def _hierarchical(spark: SparkSession, sf: str) -> DataFrame:
    d = fx.descriptors(spark, sf, "lineitem")
    return mix.mix_in_levels([fx.rules(spark, fx.GROUPS), fx.rules(spark, fx.FLAT)], d).rows


def _size_probes(spark, sf):
    return fx.mb_probes(spark, sf, "cache_mb")


def _rate_probes(spark, sf):
    return fx.table(spark, sf, "events").selectExpr(
        "event_type AS fd_id", "CAST(event_id % 1000 AS DOUBLE) / 10D AS hit_pct"
    )


def _object_probes(spark, sf):
    return fx.table(spark, sf, "events").selectExpr(
        "event_type AS fd_id", "user_id AS cache_objects"
    )


def _asked_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """One footprint to look up per part."""
    return fx.table(spark, sf, "part").selectExpr(
        "concat('g', p_partkey % 20) AS fd_id", "((p_partkey * 7) div 20 % 500) * 10 AS mb"
    )


def _concat_of(part: str, **options) -> Query:
    return lambda spark, sf: getattr(
        concat(fx.concat_rules(spark), fx.descriptors(spark, sf, "events"), **options), part
    )


def _concat_limited(spark: SparkSession, sf: str) -> DataFrame:
    """With a limit of half the largest footprint."""
    d = fx.descriptors(spark, sf, "events")
    limit = d.rows.agg(F.max("mb")).first()[0] // 2
    return concat(fx.concat_rules(spark), d, cmax=limit).rows


def _ranked(ordered: DataFrame) -> DataFrame:
    """The place of each row of a report (a row per class) in the order it came in."""
    placed = ordered.withColumn("_at", F.monotonically_increasing_id())
    return placed.withColumn("rank", F.row_number().over(Window.orderBy("_at")).cast("long")).drop("_at")


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    table = fx.rules(spark, fx.HALF_ALL, fx.MIXED_OPS)
    return mix.prepared_rows(table, fx.descriptors(spark, sf, "events")).drop("fd_id")


def _round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Descriptors written as text to the shared folder and read again."""
    path = new_path(spark, "text")
    write_descriptors(fx.descriptors(spark, sf, "lineitem"), path, form="text")
    return read_descriptors(spark, path, folders=True).descriptors.rows


#: Triggers of the streamed build.
TRIGGERS = 3


def _streamed(spark: SparkSession, sf: str) -> DataFrame:
    """The events log as lines in several files, pushed through the streaming build one file
    at a time."""
    path = new_path(spark, "stream")
    log = fx.events_log(spark, sf)
    t0, t1 = log.agg(F.min("sec"), F.max("sec")).first()
    step = (t1 - t0) // TRIGGERS + 1
    for k in range(TRIGGERS):
        part = log.filter(F.col("sec").between(t0 + k * step, t0 + (k + 1) * step - 1))
        part.selectExpr("concat_ws(':', ord2, sec, obj, sz, sz, 0, fd_id, 0) AS value").coalesce(1).write.mode(
            "append").text(f"{path}/lines")
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{path}/lines")
    live.start(lines, f"{path}/table", f"{path}/checkpoint").awaitTermination()
    changes = materialize(live.LiveTable(spark, f"{path}/table").finished(), "finished")
    return accesslog.rows_from_traffic(changes).select(ROW_COLS)


def _footprint(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Average footprints of a log's classes, computed from the log."""
    log = fx.LOGS[name][0](spark, sf)
    objects = materialize(accesslog.object_totals(log), "objects")
    numbered = accesslog.numbered_accesses(log, objects)
    return accesslog.average_footprint(
        materialize(accesslog.gaps(numbered, objects), "gaps"), objects)


def _bundle(spark: SparkSession, sf: str):
    path = new_path(spark, "bundle")
    write_flat(fx.bundle_lines(spark), path, "")
    return read_bundle(spark, path)


def _mix_bundle(spark: SparkSession, sf: str) -> DataFrame:
    """All mixes of a rule set of the bundled shape: groups, then the mix of groups."""
    table = materialize(_bundle(spark, sf).rules, "bundle-rules")
    top = F.col("mix_id") == "flat"
    d = fx.descriptors(spark, sf, "parts")
    return mix.mix_in_levels([table.filter(~top), table.filter(top)], d, every_level=True).rows.select(ROW_COLS)


def _indexed(spark: SparkSession, sf: str) -> DataFrame:
    """IATs by footprint from a stored index."""
    name = f"iats_{uuid.uuid4().hex}"
    lookup.store_iat_index(fx.descriptors(spark, sf, "lineitem").rows, name, new_path(spark, "iats"))
    return lookup.iats_in_index(spark, name, _asked_sizes(spark, sf))


def _sizes(spark: SparkSession, sf: str) -> list[int]:
    most = fx.largest_mb(spark, sf)
    return [most * n // of + more for n, of, more in PARTS]


def _within(spark: SparkSession, sf: str, **options) -> DataFrame:
    """As-of rows within three tenths of the largest footprint and above five objects."""
    d, most = fx.descriptors(spark, sf, "events"), fx.largest_mb(spark, sf) * 3 // 10
    return lookup.asof_within(d.rows, fx.iat_probes(spark, sf), curves.Quota(max_mb=most, min_count=5), **options)


def _matching_within(spark: SparkSession, sf: str) -> DataFrame:
    d, most = fx.descriptors(spark, sf, "events"), fx.largest_mb(spark, sf) * 3 // 10
    return lookup.matching_within(d.rows, fx.iat_probes(spark, sf), curves.Quota(max_mb=most, min_count=5))


def _curve_within(spark: SparkSession, sf: str) -> DataFrame:
    d, most = fx.descriptors(spark, sf, "events"), fx.largest_mb(spark, sf) * 2 // 5
    return curves.space_curve(d, quota=curves.Quota(max_mb=most, min_count=3))


def _several_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """Validity where every class has a fault of its own."""
    d = fx.descriptors(spark, sf, "lineitem")
    n = "CAST(substring(fd_id, 2) AS INT)"
    headers = d.headers.selectExpr(*[
        f"if({n} % 5 = 1, 0L, {c}) AS {c}" if c == "total_requests" else
        f"if({n} % 5 = 2, 0L, {c}) AS {c}" if c == "total_served_bytes" else c for c in HEADER_COLS])
    return transform.validity(Descriptors(headers, d.rows.filter(f"{n} % 5 <> 3")))


def _space(d) -> DataFrame:
    """A stored space curve, as the lookups find it."""
    return materialize(curves.space_curve(d), "space-curve")


def _count(d) -> DataFrame:
    return materialize(curves.count_curve(d), "count-curve")


def _run_summary(spark: SparkSession, sf: str) -> DataFrame:
    table = fx.rules(spark, fx.HALF_ALL, fx.MIXED_OPS)
    d = fx.descriptors(spark, sf, "events")
    done = mix.mix(table, d).rows.select("fd_id").distinct()
    return summary.run_summary(done, mix.missing_members(table, d.headers))


#: Transforms whose headers are registered too.
HEADERS_OF = {
    "scale_absolute": lambda d: transform.scale(d, 2.0),
    "scale_to_traffic": lambda d: transform.scale_to_traffic(d, 50.0),
    "shard": lambda d: transform.shard(d, 3.0),
    "unshard": lambda d: transform.unshard(d, 2.5),
    "shard_fraction": lambda d: transform.shard_fraction(d, 3, 7),
    "stretch_duration": lambda d: transform.stretch_duration(d, 604800),
    "split_virtual": lambda d: transform.split_virtual(d, 4),
}


def all_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["mixed_space_curve"] = mixed_space_curve
    q["fd_from_events"] = lambda s, sf: _built(s, sf, "events")
    q["fd_from_lineitem"] = lambda s, sf: _built(s, sf, "lineitem")
    q["fd_headers"] = _built_headers
    q["footprint_events"] = lambda s, sf: _footprint(s, sf, "events")
    q["footprint_lineitem"] = lambda s, sf: _footprint(s, sf, "lineitem")
    q["scale_absolute"] = _events(lambda d: transform.scale(d, 2.0).rows)
    q["scale_collision_merge"] = _lines(lambda d: transform.scale(d, 3.0, "merge").rows)
    q["scale_to_traffic"] = _events(lambda d: transform.scale_to_traffic(d, 50.0).rows)
    q["shard"] = _events(lambda d: transform.shard(d, 3.0).rows)
    q["unshard"] = _events(lambda d: transform.unshard(d, 2.5).rows)
    q["shard_fraction"] = _events(lambda d: transform.shard_fraction(d, 3, 7).rows)
    q["subtract"] = lambda s, sf: _mixed(fx.SUBTRACT)(s, sf).rows
    q["add_two"] = _events(lambda d: mix.add(d.named("click"), d.named("view"), "pair").rows)
    q["mix_nway"] = lambda s, sf: _mixed(fx.HALF_ALL, fx.ONE_ALL, fx.MIXED_OPS)(s, sf).rows
    q["prepared_members"] = _prepared
    q["mix_merged_collisions"] = lambda s, sf: mix.mix(
        fx.rules(s, fx.SHRUNK), fx.descriptors(s, sf, "lineitem"), collision="merge").rows
    q["mix_in_rule_order"] = lambda s, sf: mix.mix_in_rule_order(
        fx.rules(s, fx.HALF_ALL), fx.descriptors(s, sf, "events")).rows
    q["mix_order_cancelling"] = lambda s, sf: mix.mix_in_rule_order(
        fx.rules(s, fx.CANCELLING), fx.descriptors(s, sf, "events")).rows
    for name, change in HEADERS_OF.items():
        q[f"{name}_headers"] = _events(lambda d, change=change: change(d).headers)
    q["text_round_trip"] = _round_trip
    q["fd_from_stream"] = _streamed
    q["mix_bundle"] = _mix_bundle
    q["bundle_missing"] = lambda s, sf: _bundle(s, sf).missing
    q["mix_float32"] = lambda s, sf: _mixed(fx.TENTH, compat_float32=True)(s, sf).rows
    q["unshard_float32"] = _events(lambda d: transform.unshard(d, 2.5, True).rows)
    q["mix_equalized_headers"] = lambda s, sf: _mixed(fx.ONE_ALL, equalize_durations=True)(s, sf).headers
    q["mix_headers"] = lambda s, sf: _mixed(
        fx.HALF_ALL, fx.ONE_ALL, fx.MIXED_OPS, fx.SUBTRACT)(s, sf).headers
    q["mix_equalized"] = lambda s, sf: _mixed(fx.ONE_ALL, equalize_durations=True)(s, sf).rows
    q["mix_hierarchical"] = _hierarchical
    q["t2s"] = _events(curves.space_curve)
    q["t2c"] = _lines(curves.count_curve)
    q["t2s_icp"] = _lines(lambda d: curves.space_curve(d, include_transitions=True))
    q["t2c_icp"] = _events(lambda d: curves.count_curve(d, include_transitions=True))
    q["t2s_quota"] = _curve_within
    q["thin"] = _lines(lambda d: thin.thin(d.rows, THIN_PCT))
    for pct in (0, 100, 150):
        q[f"thin_{pct}"] = _lines(lambda d, pct=pct: thin.thin(d.rows, pct))
    q["cum_bytes"] = _events(lambda d: lookup.with_cum_bytes(d.rows.select(ROW_COLS)))
    q["asof_lookup"] = _probed(lambda d, p: lookup.asof(d.rows, p), fx.iat_probes)
    q["matching_lookup"] = _probed(lambda d, p: lookup.matching(d.rows, p), fx.iat_probes)
    q["asof_quota"] = _within
    q["asof_quota_unset_is_zero"] = lambda s, sf: _within(s, sf, unset_is_zero=True)
    q["matching_quota"] = _matching_within
    q["stack_distance_at"] = _probed(
        lambda d, p: lookup.stack_distance(d.rows, p), fx.iat_probes)
    q["iat_for_mb"] = _probed(lambda d, p: lookup.iat_for_mb(d.rows, p), fx.mb_probes)
    q["iats_with_mb"] = lambda s, sf: lookup.iats_with_mb(
        fx.descriptors(s, sf, "lineitem").rows, _asked_sizes(s, sf))
    q["iats_index"] = _indexed
    q["stack_distances"] = _lines(lambda d: lookup.stack_distances(d.rows))
    q["markers"] = lambda s, sf: lookup.markers(fx.descriptors(s, sf, "events").rows, _sizes(s, sf))
    q["quick_add"] = lambda s, sf: quickadd.quick_add(
        fx.sharers(s), fx.descriptors(s, sf, "events"), fx.largest_mb(s, sf) // 3)
    q["quick_lookup"] = lambda s, sf: quickadd.quick_lookup(
        fx.descriptors(s, sf, "events"), fx.largest_mb(s, sf) // 5)
    q["concat"] = _concat_of("rows")
    q["concat_weighted"] = _concat_of("rows", weigh_by_traffic=True)
    q["concat_limited"] = _concat_limited
    q["concat_headers"] = lambda s, sf: concat_headers(
        read_scaled(fx.concat_rules(s), fx.descriptors(s, sf, "events"))[0], min_ghost=2)
    q["curve_lookup"] = _probed(
        lambda d, p: lookup.curve_lookup(_space(d), p), _size_probes)
    q["hit_rate_at"] = _probed(
        lambda d, p: lookup.hit_rate_at(_space(d), d.headers, p), _size_probes)
    q["max_hit_rate"] = _lines(lambda d: curves.max_hit_rate(curves.space_curve(d), d.headers))
    q["size_for_hit_rate"] = _probed(
        lambda d, p: lookup.size_for_hit_rate(_space(d), d.headers, p), _rate_probes)
    q["count_lookup"] = _probed(
        lambda d, p: lookup.count_lookup(_count(d), p), _object_probes)
    q["stretch_duration"] = _events(lambda d: transform.stretch_duration(d, 604800).rows)
    q["split_virtual"] = _events(lambda d: transform.split_virtual(d, 4).rows)
    q["traffic_summary"] = lambda s, sf: summary.traffic_summary(_all_headers(s, sf))
    q["extents"] = _lines(lambda d: summary.extents(d.rows))
    q["order_fds"] = _lines(lambda d: _ranked(summary.order_descriptors(d.headers)))
    q["order_curves"] = _lines(
        lambda d: _ranked(summary.order_curves(curves.space_curve(d), descending=True)))
    q["validity"] = _events(transform.validity)
    q["validity_verdicts"] = _several_verdicts
    q["customer_map_rules"] = lambda s, sf: rules_from_customer_map(
        fx.customer_map(s, sf)).select("mix_id", "ord", "fd_id", "op", "scale", "scale_type")
    q["rule_binding_missing"] = lambda s, sf: mix.missing_members(
        fx.rules(s, fx.HALF_ALL, fx.MIXED_OPS), fx.descriptors(s, sf, "events").headers)
    q["run_summary"] = _run_summary
    return q | files.all_queries()
