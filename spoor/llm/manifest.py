"""Merkle manifest of a dataset, with a proof per row by pointer jumping.

Every row is a leaf, the digest of its columns.  The leaves of a group, by id, form a
binary tree; the roots of the groups, by the group's value, form one more.  A proof is the
list of the digests beside the way from a leaf to the root.

The levels are hashed from the bottom, ``2 ** SPAN`` nodes of one tree at a time, so no
group comes into one task.  Every node but the root then points to its parent and holds one
hop: the digest beside it and its side.  In each round the table of nodes is joined with
itself by the pointer: a node takes over the pointer of the node it points to and appends
that node's hops, so the distance doubles until all leaves point past the root.  In the
k-th round only nodes on levels divisible by ``2 ** k`` (and those of the upper tree) are
pointed to, so the others are left out.

Digests are SHA-256; they are hashed as lowercase hex text and stored as 32 bytes.

Cases: a null column is ``-`` in the leaf; rows of null id come first, rows of null group
are a group, the first; repeated rows are leaves each; rows of one id are ordered by their
leaf; a group of one row has its leaf as root, one group alone has its root as the root of
all; an empty table gives an empty result; further columns are left aside.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.llm.common import Batches, in_arrow, numbered
from spoor.session import materialize

#: Levels hashed in one task from 2 ** SPAN nodes of one tree.
SPAN = 10

# Columns of a leaf, in order; bytes of a hop (its side, then the digest).
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
HOP = 33

#: The number of the tree over the groups' roots; groups are numbered from 0.
UPPER = -1

_NODES = "tree long, level int, at long"


def leaf(columns: list[Column]) -> Column:
    """Hex digest of the columns: ``-`` for null, else length in bytes, colon, value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(
            F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _parent(run: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(run).hex().encode()).digest()


def _levels(level: int, first: int, total: int, hashes: list[bytes], span: int):
    """Levels (level, first place, total nodes of the tree on it, digests) over neighbouring
    nodes of one tree, up to ``span`` above or the tree's root."""
    yield level, first, total, hashes
    for _ in range(span):
        if total == 1:
            return
        hashes = [_parent(hashes[i : i + 2]) for i in range(0, len(hashes), 2)]
        level, first, total = level + 1, first // 2, (total + 1) // 2
        yield level, first, total, hashes


_HOPS = f"{_NODES}, up_tree long, up_level int, up_at long, hops binary, total long, digest binary"


def _hashed(span: int):
    """From runs of neighbouring nodes: a row per node with its hop and its parent, and rows
    without hop for the last level, which goes on: the root or a node to be hashed."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out: dict[str, list] = {c.split()[0]: [] for c in _HOPS.split(", ")}
            for tree, level, total, nodes in zip(*(batch.column(c).to_pylist() for c in (
                    "tree", "level", "total", "nodes"))):
                ladder = list(_levels(level, nodes[0]["at"], total, [n["digest"] for n in nodes], span))
                for lv, first, width, hashes in ladder:
                    last = lv == ladder[-1][0]
                    for i, digest in enumerate(hashes):
                        at, beside = first + i, (first + i) ^ 1
                        side = b"O" if beside >= width else b"R" if beside > at else b"L"
                        hop = side + (bytes(32) if side == b"O" else b"" if last else hashes[beside - first])
                        up = (None, None, None, None) if last else (tree, lv + 1, at // 2, hop)
                        for c, x in zip(out, (tree, lv, at, *up, width, digest)):
                            out[c].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("tree", pa.int64()), ("level", pa.int32()), ("at", pa.int64()), ("up_tree", pa.int64()),
                ("up_level", pa.int32()), ("up_at", pa.int64()), ("hops", pa.binary()),
                ("total", pa.int64()), ("digest", pa.binary())]))

    return run


def _built(leaves: DataFrame, most: int, span: int) -> tuple[DataFrame, DataFrame]:
    """Nodes with a hop, and the roots, of the trees over ``leaves(tree, at, total,
    digest)``; ``most``: leaves of the largest tree."""
    todo, found, roots = leaves.withColumn("level", F.lit(0)), [], []
    while True:
        runs = todo.groupBy("tree", F.shiftright("at", span).alias("run")).agg(
            F.first("level").alias("level"), F.first("total").alias("total"),
            F.sort_array(F.collect_list(F.struct("at", "digest"))).alias("nodes"))
        rows = materialize(in_arrow(runs, lambda: _hashed(span), _HOPS), "tree-nodes")
        found.append(rows.where("hops IS NOT NULL").drop("total"))
        todo = rows.where("hops IS NULL").select("tree", "level", "at", "total", "digest")
        roots.append(todo.where("total = 1").drop("total"))
        todo, most = todo.where("total > 1"), -(-most // 2**span)
        if most <= 1:
            return _united(found), _united(roots)


def _united(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _jumped(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` with the pointer and the hops of the node they point to, if there is one."""
    up = nodes.select(*[F.col(c).alias(f"to_{c}") for c in (
        "tree", "level", "at", "up_tree", "up_level", "up_at", "hops")])
    same = [F.col(f"up_{c}") == F.col(f"to_{c}") for c in ("tree", "level", "at")]
    own = [c for c in rows.columns if c not in ("up_tree", "up_level", "up_at", "hops")]
    return rows.join(up, same[0] & same[1] & same[2], "left").select(
        *own, *[F.col(f"to_up_{c}").alias(f"up_{c}") for c in ("tree", "level", "at")],
        F.concat("hops", F.coalesce("to_hops", F.lit(b""))).alias("hops"))


def proofs(leaves: DataFrame, nodes: DataFrame, height: int) -> DataFrame:
    """``leaves`` with the hops from each to the root, by pointer jumping; ``height``: most
    hops of a leaf.  A leaf's row carries its further columns along."""
    start = nodes.select("tree", "level", "at", "up_tree", "up_level", "up_at", "hops")
    key = ["tree", "level", "at"]
    rows = leaves.withColumn("level", F.lit(0)).join(start, key, "left").drop(*key)
    rows = rows.withColumn("hops", F.coalesce("hops", F.lit(b"")))
    far, arrived = 1, []
    while far < height:
        rows = materialize(rows, "pointers")
        arrived.append(rows.where("up_at IS NULL"))
        rows = _jumped(rows.where("up_at IS NOT NULL"), start)
        far *= 2
        if far >= height:
            break
        # The nodes pointed to in the next round.
        used = start.where((F.col("tree") == UPPER) | (F.col("level") % far == 0))
        going = _jumped(used.where("up_at IS NOT NULL"), start)
        start = materialize(going.unionByName(used.where("up_at IS NULL")), "jumps")
    return _united([*arrived, rows])


def _height(n: int) -> int:
    return max(n - 1, 0).bit_length()


def folded(start: Column, hops: Column) -> Column:
    """The root that a leaf (hex) and its hops give."""
    def step(acc, i):
        side = F.substring(hops, i * HOP + 1, 1)
        beside = F.lower(F.hex(F.substring(hops, i * HOP + 2, HOP - 1)))
        return F.sha2(F.when(side == F.lit(b"L"), F.concat(beside, acc)).when(
            side == F.lit(b"R"), F.concat(acc, beside)).otherwise(acc), 256)

    return F.aggregate(_steps(hops), start, step)


def _steps(hops: Column) -> Column:
    n = (F.octet_length(hops) / HOP).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def siblings(hops: Column) -> Column:
    """The digests beside the way, as one hex text."""
    beside = F.transform(_steps(hops), lambda i: F.when(
        F.substring(hops, i * HOP + 1, 1) != F.lit(b"O"),
        F.lower(F.hex(F.substring(hops, i * HOP + 2, HOP - 1)))).otherwise(""))
    return F.array_join(beside, "")


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id",
             group_col: str = "lang", more: dict[str, Column] | None = None,
             span: int = SPAN) -> DataFrame:
    """doc_id, leaf, subroot, root (hex) and hops (bytes) of every row, and the columns
    ``more`` worked out from the row."""
    leaves = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{group_col}`").cast("string").alias("lang"),
        F.unhex(leaf([F.col(f"`{c}`") for c in columns])).alias("digest"),
        *[c.alias(name) for name, c in (more or {}).items()])
    leaves = materialize(leaves, "leaves")
    groups = leaves.groupBy("lang").agg(F.count("*").alias("total"))
    groups = materialize(numbered(groups, [F.col("lang").asc_nulls_first()], name="tree").select(
        F.col("lang").alias("of_lang"), "tree", "total"), "groups")
    n, most = groups.agg(F.count("*"), F.coalesce(F.max("total"), F.lit(0))).first()
    leaves = leaves.join(groups, F.col("lang").eqNullSafe(F.col("of_lang"))).drop("lang", "of_lang")
    leaves = materialize(numbered(
        leaves, [F.col("doc_id").asc_nulls_first(), F.col("digest")], ("tree",)), "numbered-leaves")
    own, subroots = _built(leaves.select("tree", "at", "total", "digest"), most, span)
    subroots = materialize(subroots, "subroots")
    upper, top = _built(subroots.select(
        F.lit(UPPER).cast("long").alias("tree"), F.col("tree").alias("at"),
        F.lit(n).cast("long").alias("total"), "digest"), n, span)
    # A group's root is a leaf of the upper tree and goes by its own name.
    below = subroots.select(F.col("tree").alias("of"), F.col("level").alias("own_level"),
                            F.col("at").alias("own_at"))
    first = upper.where("level = 0").join(below, F.col("at") == F.col("of")).select(
        F.col("of").alias("tree"), F.col("own_level").alias("level"), F.col("own_at").alias("at"),
        "up_tree", "up_level", "up_at", "hops", "digest")
    nodes = own.unionByName(upper.where("level > 0")).unionByName(first)
    nodes = materialize(nodes.drop("digest"), "hops")
    root = top.select("digest").first()  # one row
    found = proofs(leaves.drop("total").withColumn("of_tree", F.col("tree")), nodes,
                   _height(most) + _height(n))
    roots = subroots.select(F.col("tree").alias("of"), F.lower(F.hex("digest")).alias("subroot"))
    return found.join(roots, F.col("of_tree") == F.col("of")).select(
        "doc_id", F.lower(F.hex("digest")).alias("leaf"), "subroot",
        F.lit(root["digest"].hex() if root else None).alias("root"), "hops", *(more or {}))


def verified(rows: DataFrame, seen: str = "seen") -> DataFrame:
    """Adds proof_sha256, folded_root (from the leaf in column ``seen``) and verified."""
    return rows.withColumn("proof_sha256", F.sha2(siblings(F.col("hops")), 256)).withColumn(
        "folded_root", folded(F.col(seen), F.col("hops"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
