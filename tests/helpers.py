"""Tiny descriptors and plain-Python definitions to compare with."""

from __future__ import annotations

import random

from spoor.model import HEADER_COLS, HEADER_SCHEMA, ROW_COLS, ROW_SCHEMA, Descriptors

TRAFFIC = ROW_COLS[4:]


def make(spark, bodies: dict[str, list[tuple]], headers: dict[str, dict] | None = None):
    """Descriptors from ``{name: [(delta_t, mb, objcount, req, bytes, trb, trr)]}``."""
    heads = []
    for name, rows in bodies.items():
        h = dict(
            fd_id=name,
            total_requests=sum(r[3] for r in rows) + 10,
            total_served_bytes=sum(r[4] for r in rows) + 1000,
            duration=100,
            total_mib=0,
            unique_objects=5,
            unique_bytes=50,
            peak_requests_300s=3,
            peak_bytes_300s=30,
        )
        h.update((headers or {}).get(name, {}))
        heads.append(tuple(h[c] for c in HEADER_COLS))
    flat = [(name, *r) for name, rows in bodies.items() for r in rows]
    return Descriptors(
        spark.createDataFrame(heads, HEADER_SCHEMA), spark.createDataFrame(flat, ROW_SCHEMA)
    )


def rows_of(df, *columns):
    columns = columns or ROW_COLS
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def random_body(rng: random.Random, n: int, silent: bool = False, top: int = 400) -> list[tuple]:
    times = sorted(rng.sample(range(top), n))
    mb = objects = 0
    body = []
    for t in times:
        mb += rng.randint(0, 5)
        objects += rng.randint(0, 3)
        quiet = silent and rng.random() < 0.3
        body.append(
            (t, mb, objects, *([0] * 4 if quiet else [rng.randint(1, 9) for _ in range(4)]))
        )
    return body


def floor_row(body: list[tuple], t: int) -> tuple:
    below = [r for r in body if r[0] <= t]
    return below[-1] if below else body[0]


def add_bodies(a: list[tuple], b: list[tuple]) -> list[tuple]:
    """Two step functions added on the union of their IATs."""
    out = []
    for t in sorted({r[0] for r in a} | {r[0] for r in b}):
        x, y = floor_row(a, t), floor_row(b, t)
        traffic = [
            (x[i] if x[0] == t else 0) + (y[i] if y[0] == t else 0) for i in range(3, 7)
        ]
        if any(traffic):
            out.append((t, x[1] + y[1], x[2] + y[2], *traffic))
    return out


RULE_DEFAULTS = dict(op="add", scale=1.0, scale_type="absolute", num_shards=0, total_shards=0,
                     max_mb=0, min_mb=0, max_count=0, min_count=0)


def rules(spark, *given: dict):
    from spoor.model import RULE_COLS, RULE_SCHEMA

    seen: dict[str, int] = {}
    table = []
    for r in given:
        full = {**RULE_DEFAULTS, **r}
        full["ord"] = seen.get(full["mix_id"], 0)
        seen[full["mix_id"]] = full["ord"] + 1
        table.append(tuple(full[c] for c in RULE_COLS))
    return spark.createDataFrame(table, RULE_SCHEMA)
