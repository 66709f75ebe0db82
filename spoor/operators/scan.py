"""Running values along an ordered axis, split so that no key is one task.

A plain window partitioned by the key sends all rows of a key to one task.  Here
the axis of each key is cut into segments: the running value is computed inside
a segment, one summary row per segment is carried along the key in a second,
tiny window, and both are joined.  The summary has at most 32 rows per octave of
the axis (about 1,000 per key for a 32-bit axis), whatever the data; it is
pre-aggregated on the map side.  The join is left to Spark, which broadcasts the
summary only where its measured size allows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from spoor.functions.numeric import aggregates, named

SEGMENTS_PER_OCTAVE = 32
_SEG = "_segment"

_UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_ALL = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"


def segment_of(axis: str, per_octave: int = SEGMENTS_PER_OCTAVE) -> str:
    """Segment number of an axis value: never decreases as the value grows.

    It is never NULL, so joins on it add no filter that would set equal subplans
    apart and keep their shuffles from being shared.
    """
    steps = f"floor(log2(abs({axis}) + 1.0D) * {per_octave}.0D)"
    return f"coalesce(CAST(CASE WHEN {axis} < 0 THEN -{steps} ELSE {steps} END AS INT), 0)"


@dataclass(frozen=True)
class Running:
    """One output column of :func:`scan`; ``value`` is a SQL expression.

    ``kind``
      ``sum``    running sum up to and including the row
      ``max``    running maximum up to and including the row
      ``last``   last non-null value up to and including the row
      ``next``   first non-null value from the row on
      ``lag``    value of the previous row (NULL on the key's first row)
      ``lead``   value of the next row (NULL on the key's last row)
      ``first``  value of the key's first non-null row
      ``final``  value of the key's last non-null row
      ``total``  sum over the whole key
      ``least``  minimum over the whole key
      ``most``   maximum over the whole key
    """

    kind: str
    value: str


@dataclass(frozen=True)
class _Parts:
    """SQL for the steps of a kind: inside a segment, of a segment, along the segments
    of a key, and put together.  ``{v}`` value, ``{a}`` axis, ``{s}`` segment summary,
    ``{inside}`` and ``{along}`` windows (``_back``: in falling order), ``{here}`` and
    ``{brought}`` the two results."""

    inside: str | None
    summary: str
    along: str
    merged: str


_KINDS = {
    "sum": _Parts(f"sum({{v}}) OVER ({{inside}} {_UPTO})", "sum({v})",
                  f"sum({{s}}) OVER ({{along}} {_BEFORE})",
                  "coalesce({here}, 0) + coalesce({brought}, 0)"),
    "max": _Parts(f"max({{v}}) OVER ({{inside}} {_UPTO})", "max({v})",
                  f"max({{s}}) OVER ({{along}} {_BEFORE})", "greatest({here}, {brought})"),
    "last": _Parts(f"last({{v}}) IGNORE NULLS OVER ({{inside}} {_UPTO})",
                   "max_by({v}, CASE WHEN ({v}) IS NOT NULL THEN {a} END)",
                   f"last({{s}}) IGNORE NULLS OVER ({{along}} {_BEFORE})",
                   "coalesce({here}, {brought})"),
    # read backwards: a frame up to the last row is evaluated anew for every row
    "next": _Parts(f"last({{v}}) IGNORE NULLS OVER ({{inside_back}} {_UPTO})",
                   "min_by({v}, CASE WHEN ({v}) IS NOT NULL THEN {a} END)",
                   f"last({{s}}) IGNORE NULLS OVER ({{along_back}} {_BEFORE})",
                   "coalesce({here}, {brought})"),
    "lag": _Parts("lag({v}) OVER ({inside})", "max_by({v}, {a})", "lag({s}) OVER ({along})",
                  "coalesce({here}, {brought})"),
    "lead": _Parts("lead({v}) OVER ({inside})", "min_by({v}, {a})", "lead({s}) OVER ({along})",
                   "coalesce({here}, {brought})"),
    "first": _Parts(None, "min_by({v}, CASE WHEN ({v}) IS NOT NULL THEN {a} END)",
                    f"first({{s}}) IGNORE NULLS OVER ({{along}} {_ALL})", "{brought}"),
    "final": _Parts(None, "max_by({v}, CASE WHEN ({v}) IS NOT NULL THEN {a} END)",
                    f"last({{s}}) IGNORE NULLS OVER ({{along}} {_ALL})", "{brought}"),
    "total": _Parts(None, "sum({v})", f"sum({{s}}) OVER ({{along}} {_ALL})", "{brought}"),
    "least": _Parts(None, "min({v})", f"min({{s}}) OVER ({{along}} {_ALL})", "{brought}"),
    "most": _Parts(None, "max({v})", f"max({{s}}) OVER ({{along}} {_ALL})", "{brought}"),
}


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: dict[str, Running],
    source: DataFrame | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus the running ``columns``; ``order[0]`` is the axis.

    Columns of kind ``last``, ``next``, ``lag``, ``lead``, ``first`` and ``final`` expect at
    most one non-null value per key and axis value.  The other columns in
    ``order`` only break ties between rows of equal axis value.

    ``source`` may name the rows that ``df`` was summed up from.  For sums and
    totals the segments are then summed from it directly, without the shuffle that
    made ``df``.  It has to hold every key and axis value of ``df``.

    ``beside`` may hold one row per key whose columns are wanted with every row; keys
    without one drop out.  It is joined to the few segment rows, not to ``df``.
    """
    if source is not None and any(r.kind not in ("sum", "total") for r in columns.values()):
        raise ValueError("a source is only of use for sums")
    axis, key = order[0], ", ".join(keys)
    falling = ", ".join(f"{c} DESC" for c in order)
    words = {
        "a": axis,
        "inside": f"PARTITION BY {key}, {_SEG} ORDER BY {', '.join(order)}",
        "inside_back": f"PARTITION BY {key}, {_SEG} ORDER BY {falling}",
        "along": f"PARTITION BY {key} ORDER BY {_SEG}",
        "along_back": f"PARTITION BY {key} ORDER BY {_SEG} DESC",
    }
    segment = f"{segment_of(axis)} AS {_SEG}"

    local, summed, carried, final = {}, {}, {}, {}
    for name, r in columns.items():
        parts, here, brought = _KINDS[r.kind], f"_in_{name}", f"_by_{name}"
        words |= {"v": r.value, "s": f"_s_{name}", "here": here, "brought": brought}
        if parts.inside is not None:
            local[here] = parts.inside.format(**words)
        summed[f"_s_{name}"] = parts.summary.format(**words)
        carried[brought] = parts.along.format(**words)
        final[name] = parts.merged.format(**words)

    split = df.selectExpr("*", segment)
    pieces = split if source is None else source.selectExpr("*", segment)
    summary = pieces.groupBy(*keys, _SEG).agg(*aggregates(summed))
    carry = summary.selectExpr(*keys, _SEG, *named(carried))
    extra = []
    if beside is not None:
        carry = carry.join(beside, keys)
        extra = [c for c in beside.columns if c not in keys]
    # spelled out: rows that come partitioned by the key alone must not stay together
    spread = split.repartition(*keys, _SEG)
    joined = spread.selectExpr("*", *named(local)).join(carry, [*keys, _SEG])
    return joined.selectExpr(*df.columns, *named(final), *extra)

