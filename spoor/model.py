"""Column layout of the tables the package works on.

A *descriptor* describes one traffic class.  All descriptors live together in
two DataFrames: ``headers`` (one row per ``fd_id``) and ``rows`` (one row per
``fd_id`` and inter-arrival time ``delta_t``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAFFIC_COLS = ["requests", "bytes", "tr_bytes", "tr_requests"]
ROW_COLS = ["fd_id", "delta_t", "mb", "objcount", *TRAFFIC_COLS]
# values of the neighbouring rows of the same descriptor, optional in a rows table
LINK_COLS = ["prev_mb", "prev_objcount", "next_delta_t", "first_delta_t"]

# header fields that follow the traffic volume, and those that count distinct content
VOLUME_COLS = [
    "total_requests",
    "total_served_bytes",
    "total_mib",
    "peak_requests_300s",
    "peak_bytes_300s",
]
UNIQUE_COLS = ["unique_objects", "unique_bytes"]
HEADER_COLS = [
    "fd_id",
    "total_requests",
    "total_served_bytes",
    "duration",
    "total_mib",
    "unique_objects",
    "unique_bytes",
    "peak_requests_300s",
    "peak_bytes_300s",
]

HEADER_SCHEMA = "fd_id string, " + ", ".join(f"{c} bigint" for c in HEADER_COLS[1:])
ROW_SCHEMA = "fd_id string, " + ", ".join(f"{c} bigint" for c in ROW_COLS[1:])

RULE_SCHEMA = (
    "mix_id string, ord int, fd_id string, op string, scale double, scale_type string, "
    "num_shards int, total_shards int, max_mb bigint, min_mb bigint, "
    "max_count bigint, min_count bigint"
)
RULE_COLS = [f.split()[0] for f in RULE_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Descriptors:
    """Any number of descriptors: a header table and a body table."""

    headers: DataFrame
    rows: DataFrame

    def named(self, *fd_ids: str) -> Descriptors:
        """Only the descriptors with the given names; the filter reaches the scan."""
        keep = F.col("fd_id").isin(*fd_ids)
        return Descriptors(self.headers.filter(keep), self.rows.filter(keep))

    def union(self, other: Descriptors) -> Descriptors:
        """Both together; stored neighbour columns stay if both sides have them."""
        stored = set(self.rows.columns) & set(other.rows.columns)
        kept = [*ROW_COLS, *[c for c in LINK_COLS if set(LINK_COLS) <= stored]]
        return Descriptors(
            self.headers.select(HEADER_COLS).unionByName(other.headers.select(HEADER_COLS)),
            self.rows.select(kept).unionByName(other.rows.select(kept)),
        )
