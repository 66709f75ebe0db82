"""Descriptors from an access log.

Log columns: ``fd_id`` (class), ``obj``, ``sec`` (integer time), ``sz`` (bytes of
the response) and the tie-breakers ``ord1``, ``ord2`` (``ord1`` grows with ``sec``).

Access number 1 of an object is its cold miss, number 2 is counted as the 1->2
transition, later ones as regular re-accesses.  The footprint at an inter-arrival
time is, by choice, that of

``reached``  the size (number) of the objects whose shortest inter-arrival time does
             not exceed it,
``average``  the mean size (number) of the objects accessed in a window of that length,
             over all windows of the log (:func:`average_footprint`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.functions.numeric import aggregates, named, sums
from spoor.model import HEADER_COLS, ROW_COLS, TRAFFIC_COLS, Descriptors
from spoor.operators.scan import Running, scan
from spoor.operators.transform import linked
from spoor.session import materialize

# An object with more accesses than this has its history cut into stretches of about
# equally many accesses.
HOT_ACCESSES = 1_000_000
STRETCHES = 256
# Buckets in which accesses are counted to see whether there can be hot objects, and rows
# of a log that a task sorts.
BUCKETS = 1 << 16
ROWS_PER_TASK = 1_000_000
OBJECT = ["fd_id", "obj"]
# Length of a peak-traffic slot in seconds and bytes per unit of total_mib.
PEAK_SLOT = 300
MIB_UNIT = 1000


def object_totals(log: DataFrame) -> DataFrame:
    """Number, bytes and times of the accesses of each object of each class."""
    return log.groupBy("fd_id", "obj").agg(
        *aggregates({"n": "count(*)", "b": "sum(sz)", "t0": "min(sec)", "t1": "max(sec)",
                     "size": "max(sz)"})
    )


def _hot_objects(
    log: DataFrame, objects: DataFrame, hot_accesses: int
) -> tuple[DataFrame | None, int | None]:
    """Names of the objects with more accesses than that, None if there are none; and the
    number of tasks that the log needs, None if Spark's own number will do.

    An object has no more accesses than the bucket it falls into, so ``objects`` are looked
    at only if some bucket has that many.
    """
    buckets = log.groupBy(F.expr(f"pmod(xxhash64(fd_id, obj), {BUCKETS}) AS bucket")).count()
    most, rows = buckets.agg(F.max("count"), F.sum("count")).first()
    tasks = (rows or 0) // ROWS_PER_TASK + 1
    own = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = None
    if (most or 0) > hot_accesses:
        hot = materialize(
            objects.filter(F.col("n") > hot_accesses).select(*OBJECT), "hot-objects")
        hot = None if hot.isEmpty() else hot
    return hot, tasks if tasks > own else None


def _numbered_whole(log: DataFrame, tasks: int | None) -> DataFrame:
    """Accesses of objects whose history fits a task."""
    inside = "OVER (PARTITION BY fd_id, obj ORDER BY ord1, ord2, sz)"
    spread = log.repartition(tasks, *OBJECT) if tasks else log.repartition(*OBJECT)
    return spread.selectExpr(
        *OBJECT, "sec", "sz",
        f"CAST(row_number() {inside} AS BIGINT) AS k", f"sec - lag(sec) {inside} AS iat")


def _numbered_in_stretches(log: DataFrame, stretches: int) -> DataFrame:
    """Accesses of hot objects: their history is cut at quantiles of its access times into
    stretches that are numbered on their own; a count and the last access time of each
    stretch travel along the object."""
    cuts = ", ".join(str(i / stretches) for i in range(1, stretches))
    bounds = materialize(
        log.groupBy(*OBJECT).agg(*aggregates({"_bounds": f"percentile_approx(ord1, array({cuts}))"})),
        "hot-bounds",
    )
    # accesses of one time stay together: only a greater time lies behind a bound
    stretch = "size(filter(_bounds, b -> b < ord1)) AS _stretch"
    cut = log.join(bounds, OBJECT).selectExpr("*", stretch)
    along = "OVER (PARTITION BY fd_id, obj ORDER BY _stretch"
    carry = (
        cut.groupBy(*OBJECT, "_stretch")
        .agg(*aggregates({"n": "count(*)", "last_sec": "max(sec)"}))
        .selectExpr(
            *OBJECT,
            "_stretch",
            f"sum(n) {along} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _n_before",
            f"lag(last_sec) {along}) AS _sec_before",
        )
    )
    inside = "OVER (PARTITION BY fd_id, obj, _stretch ORDER BY ord1, ord2, sz)"
    # spelled out: if the join shuffled by object, hot ones still have to be spread
    spread = cut.repartition(*OBJECT, "_stretch")
    local = spread.selectExpr("*", f"row_number() {inside} AS _k", f"lag(sec) {inside} AS _prev")
    return local.join(carry, [*OBJECT, "_stretch"], "left").selectExpr(
        *OBJECT,
        "sec",
        "sz",
        "CAST(_k + coalesce(_n_before, 0) AS BIGINT) AS k",
        "sec - coalesce(_prev, _sec_before) AS iat",
    )


def _numbered_parts(
    log: DataFrame, objects: DataFrame, hot_accesses: int, stretches: int
) -> tuple[DataFrame, DataFrame | None]:
    """Accesses of the other objects and of the hot ones, None if there are none."""
    hot, tasks = _hot_objects(log, objects, hot_accesses)
    if hot is None:
        return _numbered_whole(log, tasks), None
    return (_numbered_whole(log.join(hot, OBJECT, "left_anti"), tasks),
            _numbered_in_stretches(log.join(hot, OBJECT, "left_semi"), stretches))


def numbered_accesses(
    log: DataFrame, objects: DataFrame, hot_accesses: int = HOT_ACCESSES,
    stretches: int = STRETCHES
) -> DataFrame:
    """``log`` with access number ``k`` and inter-arrival time ``iat`` per object.

    One object may own a large part of the log; the history of such hot objects is
    numbered in stretches.  The table of hot objects is written out, so its size is known
    where it is joined.
    """
    others, hot = _numbered_parts(log, objects, hot_accesses, stretches)
    return others if hot is None else others.unionByName(hot)


def traffic_by_iat(numbered: DataFrame) -> DataFrame:
    """Per class and IAT: traffic, and number and size of the objects entering there."""
    again = numbered.filter("k >= 2")
    traffic = again.selectExpr(
        "fd_id",
        "iat AS delta_t",
        "if(k >= 3, 1L, 0L) AS requests",
        "if(k >= 3, sz, 0L) AS bytes",
        "if(k = 2, sz, 0L) AS tr_bytes",
        "if(k = 2, 1L, 0L) AS tr_requests",
        "0L AS entering",
        "0L AS entering_size",
    )
    entering = (
        again.groupBy("fd_id", "obj")
        .agg(*aggregates({"delta_t": "min(iat)", "entering_size": "max(sz)"}))
        .selectExpr("fd_id", "delta_t", *[f"0L AS {c}" for c in TRAFFIC_COLS],
                    "1L AS entering", "entering_size")
    )
    return traffic.unionByName(entering).groupBy("fd_id", "delta_t").agg(
        *aggregates(sums([*TRAFFIC_COLS, "entering", "entering_size"]))
    )


def _cells(numbered: DataFrame) -> DataFrame:
    """Per class and IAT: the columns of :func:`traffic_by_iat`, the number of accesses and
    objects they come from (``seen``), and number and size of all ``objects``; those with
    one access count at IAT NULL.

    The first access of an object stands for the object.  What it has to know of the later
    ones comes along in the shuffle by object that numbered them.
    """
    whole = "OVER (PARTITION BY fd_id, obj)"
    known = numbered.selectExpr(
        "fd_id", "sz", "k", "iat", f"count(*) {whole} AS n", f"min(iat) {whole} AS least",
        f"max(if(k >= 2, sz, NULL)) {whole} AS again", f"max(sz) {whole} AS size")
    return known.selectExpr(
        "fd_id",
        *named({
            "delta_t": "if(k = 1, least, iat)",
            "requests": "if(k >= 3, 1L, 0L)",
            "bytes": "if(k >= 3, sz, 0L)",
            "tr_bytes": "if(k = 2, sz, 0L)",
            "tr_requests": "if(k = 2, 1L, 0L)",
            "entering": "if(k = 1 AND n > 1, 1L, 0L)",
            "entering_size": "if(k = 1 AND n > 1, again, 0L)",
            "seen": "if(n > 1, 1L, 0L)",
            "objects": "if(k = 1, 1L, 0L)",
            "objects_size": "if(k = 1, size, 0L)",
        }),
    )


def _hot_cells(numbered: DataFrame) -> DataFrame:
    """The same of hot objects, none of which one task could hold."""
    objects = numbered.groupBy(*OBJECT).agg(*aggregates({"objects_size": "max(sz)"}))
    none = [f"0L AS {c}" for c in [*TRAFFIC_COLS, "entering", "entering_size", "seen"]]
    return traffic_by_iat(numbered).selectExpr(
        "*", "1L AS seen", "0L AS objects", "0L AS objects_size"
    ).unionByName(objects.selectExpr(
        "fd_id", "CAST(NULL AS BIGINT) AS delta_t", *none, "1L AS objects", "objects_size"))


_CELL_SUMS = [*TRAFFIC_COLS, "entering", "entering_size", "seen", "objects", "objects_size"]


def _stored_cells(
    log: DataFrame, objects: DataFrame, hot_accesses: int = HOT_ACCESSES,
    stretches: int = STRETCHES
) -> DataFrame:
    """The cells of a log, written out: there the work in the size of the log ends."""
    others, hot = _numbered_parts(log, objects, hot_accesses, stretches)
    cells = _cells(others)
    if hot is not None:
        cells = cells.unionByName(_hot_cells(hot))
    return materialize(
        cells.groupBy("fd_id", "delta_t").agg(*aggregates(sums(_CELL_SUMS))), "traffic-by-iat")


def _traffic_of(cells: DataFrame) -> DataFrame:
    return cells.filter("seen > 0").drop("seen", "objects", "objects_size")


def rows_from_log(log: DataFrame, objects: DataFrame, **options) -> DataFrame:
    """Descriptor rows of a log, with the neighbours of each row."""
    return rows_from_traffic(_traffic_of(_stored_cells(log, objects, **options)))


def rows_from_traffic(per_iat: DataFrame) -> DataFrame:
    """Descriptor rows of a traffic-by-IAT table."""
    grown = scan(
        per_iat,
        ["fd_id"],
        ["delta_t"],
        {
            "mb": Running("sum", "entering_size"),
            "objcount": Running("sum", "entering"),
            "next_delta_t": Running("lead", "delta_t"),
            "first_delta_t": Running("first", "delta_t"),
        },
    )
    return grown.selectExpr(
        *ROW_COLS,
        "if(delta_t > first_delta_t, mb - entering_size, NULL) AS prev_mb",
        "if(delta_t > first_delta_t, objcount - entering, NULL) AS prev_objcount",
        "next_delta_t",
        "first_delta_t",
    )


_WIDE = "DECIMAL(38, 0)"


def gaps(numbered: DataFrame, objects: DataFrame) -> DataFrame:
    """Per class and length: how many stretches without an access of an object are so
    long, and the sum of the objects' sizes (``n``, ``size``); ``pairs`` of them lie between
    two accesses.

    A gap is the number of windows of one unit that start in it, plus one: from an access
    to the next one of the object, from the start of the class's log to the object's first
    access, and from its last access to the end.  An object is in every window but those
    that lie in one of its gaps, so the table is all that footprints need: the histogram
    of reuse times, and a first and a last term for each object.
    """
    ends = objects.groupBy("fd_id").agg(*aggregates({"from_sec": "min(t0)", "to_sec": "max(t1)"}))
    edges = objects.join(ends, "fd_id").selectExpr(
        "fd_id", "size",
        "explode(array(t0 - from_sec + 1, to_sec - t1 + 1)) AS gap", "1L AS n", "0L AS pairs")
    # copies of a reuse time of an object are summed before they meet its size
    again = numbered.filter("k >= 2").groupBy("fd_id", "obj", "iat").agg(*aggregates({"n": "count(*)"}))
    between = again.join(objects.select("fd_id", "obj", "size"), ["fd_id", "obj"]).selectExpr(
        "fd_id", "size * n AS size", "iat AS gap", "n", "n AS pairs")
    return edges.select(between.columns).unionByName(between).groupBy("fd_id", "gap").agg(
        *aggregates(sums(["size", "n", "pairs"])))


def average_footprint(gap_table: DataFrame, objects: DataFrame) -> DataFrame:
    """``fd_id, delta_t, mb, objcount``: mean size and number of the objects accessed in a
    window of ``delta_t``, for every reuse time of a class.

    Of the T - w + 1 windows of length w, an object misses g - w for each of its gaps g > w:

        footprint(w) = whole - sum of (g - w) over gaps g > w / (T - w + 1)

    The sum is the gaps' total less a running total, less w times the same of their
    number: two running sums along the gaps for the size and two for the number.
    """
    totals = objects.groupBy("fd_id").agg(
        *aggregates({"windows": "max(t1) - min(t0) + 2", "objects": "count(*)", "volume": "sum(size)"}))
    wide = {"n": "n", "size": "size", "far_n": "gap * n", "far_size": "gap * size"}
    swept = scan(
        gap_table.selectExpr("*", *[f"CAST({x} AS {_WIDE}) AS _{c}" for c, x in {
            "n": "n", "size": "size", "far_n": f"CAST(gap AS {_WIDE}) * n",
            "far_size": f"CAST(gap AS {_WIDE}) * size"}.items()]),
        ["fd_id"], ["gap"],
        {**{f"upto_{c}": Running("sum", f"_{c}") for c in wide},
         **{f"all_{c}": Running("total", f"_{c}") for c in wide}},
        beside=totals,
    )

    def mean(whole: str, c: str) -> str:
        missed = f"(all_far_{c} - upto_far_{c}) - gap * (all_{c} - upto_{c})"
        # every window of the log holds an object's part of the mean, cut to a whole number
        return f"CAST(({whole} * (windows - gap) - ({missed})) div (windows - gap) AS BIGINT)"

    return swept.filter("pairs > 0").selectExpr(
        "fd_id", "gap AS delta_t", f"{mean('volume', 'size')} AS mb", f"{mean('objects', 'n')} AS objcount")


def with_average_footprint(rows: DataFrame, footprint: DataFrame) -> DataFrame:
    """Descriptor rows whose footprints are those of ``footprint``."""
    traffic = rows.select("fd_id", "delta_t", *TRAFFIC_COLS)
    return linked(traffic.join(footprint, ["fd_id", "delta_t"]).select(ROW_COLS))


def _contents(objects: DataFrame) -> DataFrame:
    """Number and size of the objects of each class."""
    return objects.groupBy("fd_id").agg(
        *aggregates({"unique_objects": "count(*)", "unique_bytes": "sum(size)"}))


def _headers(
    log: DataFrame, contents: DataFrame, rows: DataFrame, seconds_per_unit: int
) -> DataFrame:
    totals = (
        log.groupBy("fd_id", F.expr(f"sec * {seconds_per_unit} div {PEAK_SLOT} AS slot"))
        .agg(*aggregates({"n": "count(*)", "b": "sum(sz)", "t0": "min(sec)", "t1": "max(sec)"}))
        .groupBy("fd_id")
        .agg(*aggregates({
            "total_requests": "sum(n)",
            "total_served_bytes": "sum(b)",
            "duration": f"CAST((max(t1) - min(t0)) * {seconds_per_unit} AS BIGINT)",
            "peak_requests_300s": "max(n)",
            "peak_bytes_300s": "max(b)",
        }))
    )
    repeated = rows.groupBy("fd_id").agg(*aggregates({"again": "sum(bytes + tr_bytes)"}))
    mib = {"total_mib": f"(total_served_bytes - coalesce(again, 0)) div {MIB_UNIT}"}
    return (
        totals.join(contents, "fd_id")
        .join(repeated, "fd_id", "left")
        .selectExpr("*", *named(mib))
        .select(HEADER_COLS)
    )


def headers_from_log(
    log: DataFrame, objects: DataFrame, rows: DataFrame, seconds_per_unit: int = 1
) -> DataFrame:
    """One header per class; ``total_mib`` is the volume of first accesses, that is
    what is not in the descriptor's ``rows``."""
    return _headers(log, _contents(objects), rows, seconds_per_unit)


def descriptors_from_log(
    log: DataFrame, seconds_per_unit: int = 1, footprint: str = "reached", **options
) -> Descriptors:
    """Descriptors of a log, stored as tables in the shared folder; ``footprint`` names
    what their footprints mean (``reached`` or ``average``)."""
    if footprint not in ("reached", "average"):
        raise ValueError(f"no such footprint: {footprint}")
    if footprint == "reached":
        cells = _stored_cells(log, object_totals(log), **options)
        rows = rows_from_traffic(_traffic_of(cells))
        contents = cells.groupBy("fd_id").agg(
            *aggregates({"unique_objects": "sum(objects)", "unique_bytes": "sum(objects_size)"}))
    else:
        objects = materialize(object_totals(log), "objects")
        numbered = materialize(numbered_accesses(log, objects, **options).filter("k >= 2"), "reuses")
        mean = average_footprint(materialize(gaps(numbered, objects), "gaps"), objects)
        rows = with_average_footprint(traffic_by_iat(numbered), mean)
        contents = _contents(objects)
    rows = materialize(rows, "rows")
    headers = materialize(_headers(log, contents, rows, seconds_per_unit), "headers")
    return Descriptors(headers, rows)
