"""Mixing: rule sets bound to descriptors, prepared and added up.

The sum of several step functions is kept as the sum of their steps: each member
row contributes the growth of its footprint since the member's previous row.
One aggregation by ``(mix_id, delta_t)`` over all members of all mixes and one
running sum along the IAT axis give every mix, whatever the number of members.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.functions.numeric import aggregates, int_div, over, sums, times
from spoor.model import HEADER_COLS, ROW_COLS, TRAFFIC_COLS, UNIQUE_COLS, VOLUME_COLS, Descriptors
from spoor.operators.scan import Running, scan
from spoor.operators.transform import (
    changed,
    linked,
    merge_collisions,
    scaled_iat,
    traffic_factor,
)
from spoor.session import materialize

AMOUNTS = ["mb", "objcount"]
_WIDE = "DECIMAL(38, 0)"


def missing_members(rules: DataFrame, headers: DataFrame) -> DataFrame:
    """Rules whose descriptor does not exist."""
    return rules.join(headers.select("fd_id"), "fd_id", "left_anti").select(
        "mix_id", "ord", "fd_id"
    )


def _fraction(x: str, single: bool = False) -> str:
    """A number of shards of ``x``, cut after each step; 1 means nothing to do."""
    one = f"if(shard_by = 1, {x}, {over(x, 'shard_by', single)})"
    return f"if(shard_times = 1, {one}, {times(one, 'shard_times', single)})"


def members(rules: DataFrame, headers: DataFrame, compat_float32: bool = False) -> DataFrame:
    """Rules joined to headers, with the factor to apply and the prepared header.

    ``status`` is ``ok``, ``empty`` (nothing left after scaling), ``no_rate`` (scaled
    to a traffic volume without having one) or ``zero_scale``.
    """
    single = compat_float32
    n, m = "coalesce(num_shards, 0)", "coalesce(total_shards, 0)"
    sharded = f"{m} > 1 AND {n} <> {m}"
    kept = ["mix_id", "ord", "fd_id", "op", "duration", "shard_by", "shard_times"]
    bound = rules.join(headers, "fd_id").selectExpr(
        "mix_id", "ord", "fd_id", "op", "duration", "scale_type",
        "CAST(CAST(scale AS FLOAT) AS DOUBLE) AS scale" if single else "scale",
        f"if({sharded}, {m}, 1) AS shard_by",
        f"if({sharded} AND {n} > 1, {n}, 1) AS shard_times",
        *VOLUME_COLS, *UNIQUE_COLS,
    )
    part = changed(bound, bound.columns,
                   dict.fromkeys([*VOLUME_COLS, *UNIQUE_COLS], lambda c: _fraction(c, single)))
    by_traffic = traffic_factor("scale", "total_served_bytes", "duration")
    scaled = part.selectExpr(
        *kept, *VOLUME_COLS, *UNIQUE_COLS,
        f"if(scale_type = 'traffic', {by_traffic}, scale) * if(op = 'sub', -1D, 1D) AS factor",
        # a `concat` line can only open a mix; it is never added to one
        "row_number() OVER (PARTITION BY mix_id ORDER BY ord) = 1 AS opens",
    )
    prepared = scaled.filter("op IN ('add', 'sub') OR opens").selectExpr(
        *kept,
        "factor",
        *[f"if(factor <> 0, {times(c, 'factor')}, NULL) AS {c}" for c in VOLUME_COLS],
        *UNIQUE_COLS,
    )
    return prepared.selectExpr(
        "*",
        "CASE WHEN factor IS NULL THEN 'no_rate' WHEN factor = 0 THEN 'zero_scale'"
        " WHEN total_requests = 0 THEN 'empty' ELSE 'ok' END AS status",
    )


def _live(found: DataFrame) -> DataFrame:
    """Members that take part, with the number of members of their mix.

    Written to the shared folder: it is read several times, and as a table its size
    is known when the join with the rows is planned.  Spark broadcasts it if it is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    return materialize(
        found.filter("status = 'ok'").selectExpr(
            "*",
            "count(*) OVER (PARTITION BY mix_id) AS n_members",
            "max(duration) OVER (PARTITION BY mix_id) AS mix_duration",
        ),
        "members",
    )


def prepared_rows(
    rules: DataFrame, d: Descriptors, collision: str = "last", compat_float32: bool = False
) -> DataFrame:
    """Rows of each member after sharding and scaling, before they are added."""
    live = _live(members(rules, d.headers, compat_float32))
    rows = _bind(live, d.rows, compat_float32)
    if collision == "last":
        rows = rows.filter("kept")
    else:
        rows = merge_collisions(rows, ["mix_id", "ord", "fd_id"])
    return rows.select("mix_id", "ord", *ROW_COLS)


def _bind(live: DataFrame, rows: DataFrame, single: bool) -> DataFrame:
    """Rules to rows by class name.  No broadcast is forced: Spark picks one where
    the rule table is known to be small, else it shuffles and splits skewed classes."""
    new_t = scaled_iat("delta_t", "factor")
    return (
        linked(rows)
        .join(
            live.select("mix_id", "ord", "fd_id", "shard_by", "shard_times", "factor",
                        "n_members", "duration", "mix_duration"),
            "fd_id",
        )
        .selectExpr(
            "mix_id", "ord", "fd_id", "n_members", "duration", "mix_duration",
            f"{new_t} AS delta_t",
            *[f"{_fraction(c, single)} AS {c}" for c in AMOUNTS],
            *[f"{_fraction(c, single)} - coalesce({_fraction('prev_' + c, single)}, 0)"
              f" AS {c}_step" for c in AMOUNTS],
            *[f"{times(_fraction(c, single), 'factor')} AS {c}" for c in TRAFFIC_COLS],
            # several old IATs may fall on one new IAT: the last one stands for them
            f"coalesce({scaled_iat('next_delta_t', 'factor')} <> {new_t}, true) AS kept",
            f"{scaled_iat('first_delta_t', 'factor')} = {new_t} AS leading",
        )
    )


def mix(
    rules: DataFrame,
    d: Descriptors,
    collision: str = "last",
    equalize_durations: bool = False,
    compat_float32: bool = False,
) -> Descriptors:
    """All mixes of a rule table; the result's ``fd_id`` is the ``mix_id``.

    At each IAT that occurs in a member: footprint = sum of the members' as-of
    footprints (before a member's first row, that of its first row), traffic = sum
    of exact matches.  Rows of a mix of two or more members that end up without any
    traffic are left out.
    """
    live = _live(members(rules, d.headers, compat_float32))
    bound = _bind(live, d.rows, compat_float32)
    if collision == "last":
        traffic = {c: f"if(kept, {c}, 0L)" for c in TRAFFIC_COLS}
    else:
        bound = _merged_steps(merge_collisions(bound, ["mix_id", "ord", "fd_id"]), live)
        traffic = {c: c for c in TRAFFIC_COLS}
    if equalize_durations:
        traffic = {c: _shared(x, "max(mix_duration)") for c, x in traffic.items()}
    else:
        traffic = {c: f"sum({x})" for c, x in traffic.items()}
    return Descriptors(_mix_headers(live, equalize_durations), _sweep(bound, traffic))


def _shared(x: str, longest: str) -> str:
    """Sum of ``x`` weighted by each member's part of the longest duration, exact."""
    weighted = f"CAST(sum(CAST({x} AS {_WIDE}) * duration) AS {_WIDE})"
    return f"CAST({int_div(weighted, longest)} AS BIGINT)"


def _sweep(bound: DataFrame, traffic: dict[str, str]) -> DataFrame:
    """Footprint steps summed per IAT and along it; ``traffic`` are the aggregates."""
    split = bound.selectExpr(
        "*",
        *[f"if(leading, {c}_step, 0L) AS {c}_base" for c in AMOUNTS],
        *[f"if(leading, 0L, {c}_step) AS {c}_grow" for c in AMOUNTS],
    )
    parts = [f"{c}_{kind}" for c in AMOUNTS for kind in ("base", "grow")]
    grid = split.groupBy("mix_id", "delta_t").agg(
        *aggregates({"n_members": "max(n_members)", **sums(parts), **traffic})
    )
    swept = scan(
        grid,
        ["mix_id"],
        ["delta_t"],
        {f"_{c}": Running("sum" if c.endswith("grow") else "total", c) for c in parts},
        source=split,
    )
    heard = " OR ".join(f"{c} <> 0" for c in TRAFFIC_COLS)
    return swept.filter(f"n_members = 1 OR {heard}").selectExpr(
        "mix_id AS fd_id",
        "delta_t",
        *[f"_{c}_base + _{c}_grow AS {c}" for c in AMOUNTS],
        *TRAFFIC_COLS,
    )


def _merged_steps(rows: DataFrame, live: DataFrame) -> DataFrame:
    """Steps of rows whose colliding IATs were merged (neighbours change by merging)."""
    linked_rows = scan(
        rows,
        ["mix_id", "ord"],
        ["delta_t"],
        {f"prev_{c}": Running("lag", c) for c in AMOUNTS},
        beside=live.select("mix_id", "ord", "n_members", "duration", "mix_duration"),
    )
    return linked_rows.selectExpr(
        "*",
        *[f"{c} - coalesce(prev_{c}, 0L) AS {c}_step" for c in AMOUNTS],
        "prev_mb IS NULL AS leading",
    )


def _mix_headers(live: DataFrame, equalize_durations: bool = False) -> DataFrame:
    total = sums([*VOLUME_COLS, *UNIQUE_COLS])
    if equalize_durations:
        for c in ("total_requests", "total_served_bytes", "total_mib"):
            total[c] = _shared(c, "max(duration)")
    return (
        live.groupBy(F.col("mix_id").alias("fd_id"))
        .agg(*aggregates({**total, "duration": "max(duration)"}))
        .select(HEADER_COLS)
    )


def add(a: Descriptors, b: Descriptors, name: str, **options) -> Descriptors:
    """The mix of two descriptors (one in ``a``, one in ``b``), called ``name``."""
    left, right = (
        side.headers.select(
            F.lit(name).alias("mix_id"), F.lit(ord_).alias("ord"), "fd_id",
            F.lit("add").alias("op"), F.lit(1.0).alias("scale"),
            F.lit("absolute").alias("scale_type"),
            F.lit(0).alias("num_shards"), F.lit(0).alias("total_shards"),
        )
        for ord_, side in ((0, a), (1, b))
    )
    return mix(left.unionByName(right), a.union(b), **options)


def mix_in_levels(
    levels: list[DataFrame], d: Descriptors, every_level: bool = False, **options
) -> Descriptors:
    """Rule tables applied one after the other; a level sees the descriptors given
    and the results of the levels before it.  Returns the last level's mixes, or those of
    all levels."""
    known, result, done = Descriptors(d.headers, linked(d.rows)), d, []
    for number, rules in enumerate(levels):
        result = mix(rules, known, **options)
        if number + 1 < len(levels):
            headers = materialize(result.headers, f"level{number}-headers")
            rows = materialize(result.rows, f"level{number}-rows")
            result = Descriptors(headers, rows)
            known = known.union(Descriptors(headers, linked(rows)))
            done.append(result)
    return reduce(Descriptors.union, done, result) if every_level else result


def mix_in_rule_order(
    rules: DataFrame, d: Descriptors, compat_float32: bool = False
) -> Descriptors:
    """The mix as a chain of two-way additions in rule order.

    Differs from :func:`mix` only where an intermediate sum has rows without
    traffic: those drop out at once and their footprint step with them until the
    next row.  A sum whose requests cancel to 0 counts as empty and is replaced by
    the next member.

    Where no sum on the way falls silent the chain is the mix, so one running sum along
    the rules finds the mixes for which it isn't, and only these are added one rule after
    the other: all together, one round per rule position.
    """
    found = members(rules, d.headers, compat_float32).filter("status = 'ok'").selectExpr(
        "*",
        "row_number() OVER (PARTITION BY mix_id ORDER BY ord) AS step",
        "count(*) OVER (PARTITION BY mix_id) AS steps",
        "sum(total_requests) OVER (PARTITION BY mix_id ORDER BY ord) AS so_far",
    )
    found = materialize(found, "chain-members")
    silent = _silent(found, d, compat_float32)
    whole = materialize(rules.join(silent, "mix_id", "left_anti"), "whole-rules")
    if whole.isEmpty():
        return _chained(found, d, compat_float32)
    plain = mix(whole, d, compat_float32=compat_float32)
    if silent.isEmpty():
        return plain
    chained = _chained(found.join(silent, "mix_id", "left_semi"), d, compat_float32)
    return Descriptors(plain.headers.unionByName(chained.headers),
                       plain.rows.select(ROW_COLS).unionByName(chained.rows.select(ROW_COLS)))


def _silent(found: DataFrame, d: Descriptors, single: bool) -> DataFrame:
    """``mix_id`` of the mixes with a sum on the way that has a row without traffic, or that
    is empty as a whole.

    Of an IAT the sums change only at the members that have a row there: what the first
    of them add up to is the sum's traffic until the next one.  The first member is no sum,
    and a row that is silent in the last sum is left out by the mix as well.
    """
    steps = found.selectExpr("mix_id", "ord", "step", "steps")
    live = found.selectExpr("*", "steps AS n_members", "duration AS mix_duration")
    rows = _bind(live, d.rows, single).filter("kept").join(steps, ["mix_id", "ord"])
    along = "OVER (PARTITION BY mix_id, delta_t ORDER BY step"
    quiet = " AND ".join(f"sum({c}) {along}) = 0" for c in TRAFFIC_COLS)
    spans = rows.selectExpr("mix_id", "steps", f"{quiet} AS quiet", "greatest(step, 2) AS since",
                            f"coalesce(lead(step) {along}) - 1, steps) AS until")
    held = spans.filter("quiet AND since <= until AND since < steps").select("mix_id")
    emptied = found.filter("so_far = 0 AND step < steps").select("mix_id")
    return materialize(held.unionByName(emptied).distinct(), "silent-mixes")


def _chained(found: DataFrame, d: Descriptors, compat_float32: bool) -> Descriptors:
    """The chain of two-way additions, one round per rule position of the longest mix; a
    round reads the members of that position and the sums of the round before."""
    chain = materialize(
        found
        .selectExpr(
            "*",
            "coalesce(lag(so_far) OVER (PARTITION BY mix_id ORDER BY ord), 0) = 0 AS alone",
        )
        .selectExpr(
            "*",
            "if(alone, 1, 2) AS n_members",
            "duration AS mix_duration",
            # sums that came out empty leave no trace: only the last start counts
            "count_if(alone) OVER (PARTITION BY mix_id ORDER BY ord) AS start",
        ),
        "chain",
    )
    last_start = chain.groupBy("mix_id").agg(*aggregates({"start": "max(start)"}))
    headers = _mix_headers(chain.join(last_start, ["mix_id", "start"]))

    parts = ["mix_id", "delta_t", *[f"{c}_step" for c in AMOUNTS], "leading", *TRAFFIC_COLS]
    turns = materialize(
        _bind(chain, d.rows, compat_float32)
        .join(chain.select("mix_id", "ord", "step", "steps"), ["mix_id", "ord"])
        .selectExpr(
            "step", "steps", "n_members", *parts[:5],
            *[f"if(kept, {c}, 0L) AS {c}" for c in TRAFFIC_COLS],
        ),
        "turns",
        by=("step",),
    )
    rounds = chain.agg(F.max("step")).first()[0] or 0
    finished = [d.rows.select(ROW_COLS).limit(0)]
    answer: DataFrame | None = None
    for step in range(1, rounds + 1):
        turn = turns.filter(F.col("step") == step).select("n_members", *parts)
        if answer is not None:
            going_on = chain.filter((F.col("step") == step) & ~F.col("alone"))
            before = (
                linked(answer)
                .join(going_on.selectExpr("mix_id AS fd_id"), "fd_id", "left_semi")
                .selectExpr(
                    "2 AS n_members",
                    "fd_id AS mix_id",
                    "delta_t",
                    *[f"{c} - coalesce(prev_{c}, 0L) AS {c}_step" for c in AMOUNTS],
                    "prev_mb IS NULL AS leading",
                    *TRAFFIC_COLS,
                )
            )
            turn = before.unionByName(turn)
        answer = materialize(_sweep(turn, sums(TRAFFIC_COLS)), f"chain-{step}")
        ending = chain.filter((F.col("step") == step) & (F.col("steps") == step))
        finished.append(
            answer.join(ending.selectExpr("mix_id AS fd_id"), "fd_id", "left_semi")
            .select(ROW_COLS)
        )
    return Descriptors(headers, reduce(DataFrame.unionByName, finished))
