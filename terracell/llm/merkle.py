"""Merkle manifest of a dataset as a persistent tree that tampered rows extend by path copying.

Rows are numbered by range partitions and the carry from one to the next. Aligned blocks of two to the power ``HEIGHT`` leaves become
subtrees in one task each, their tops are the leaves of the layer above, and so on until every group has one
block; the groups' roots form a tree of their own in the same way. The layers are tables in the shared folder.

Down again, every block learns the path from its top to the root as (side, digest) steps. A tampered leaf then makes a
version of the tree: it shares all nodes but its own ancestors, so only those are hashed anew, within its block first
and on along the block's path. Versions meet in no common task; each lives where its block lives.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import stash

# An aligned block holds two to this power of leaves.
HEIGHT = 10

# Steps of a path: which side the sibling stands on, and its digest. A node without sibling is hashed alone.
ALONE, LEFT, RIGHT = 0, 1, 2
STEP = 33

# Fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined(*digests: bytes) -> bytes:
    """SHA-256 of digests written as hex and set one after the other."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def grow(leaves: list[bytes], whole: bool, height: int) -> list[list[bytes]]:
    """Levels of a block from its leaves up. ``whole``: other blocks stand beside it, so it is carried to full height."""
    levels = [leaves]
    while len(levels[-1]) > 1 or (whole and len(levels) <= height):
        row = levels[-1]
        levels.append([joined(*row[i : i + 2]) for i in range(0, len(row), 2)])
    return levels


def path_of(levels: list[list[bytes]], i: int) -> bytes:
    """Steps from leaf ``i`` to the top of its block."""
    steps = []
    for row in levels[:-1]:
        other = i ^ 1
        if other < len(row):
            steps.append(bytes([LEFT if other < i else RIGHT]) + row[other])
        else:
            steps.append(bytes(STEP))
        i >>= 1
    return b"".join(steps)


def climb(digest: bytes, path: bytes) -> bytes:
    """The root of the version in which ``digest`` stands at the foot of ``path``."""
    for at in range(0, len(path), STEP):
        side, other = path[at], path[at + 1 : at + STEP]
        digest = joined(other, digest) if side == LEFT else joined(digest, other) if side == RIGHT else joined(digest)
    return digest


def proof(path: bytes) -> bytes:
    """Digest of the siblings along a path."""
    return joined(*[path[at + 1 : at + STEP] for at in range(0, len(path), STEP) if path[at] != ALONE])


def told(value: Column) -> Column:
    """A value as it is hashed: ``-`` for null, else its length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[told(v) for v in values]).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place of each within its group in the given order (nulls first), written as a table.

    Rows are dealt by ranges of (group, order), so a large group is spread over many tasks. Only the first group of a
    range can go on from the range before: one row a range is enough to carry the count.
    """
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    kinds = rows.schema.simpleString()[len("struct<") : -1]
    at = rows.columns.index(group)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch.column(at).dictionary_encode(null_encoding="encode").indices.to_numpy()
            heads = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            place = np.arange(batch.num_rows) - np.repeat(heads, np.diff(np.append(heads, batch.num_rows)))
            first = batch.column(at)[0].as_py()
            if last is not None and last[0] == first:
                place[: heads[1] if len(heads) > 1 else None] += n
            last, n = (batch.column(at)[-1].as_py(),), int(place[-1]) + 1
            columns = [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(place.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "place"])

    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    held = stash(dealt.mapInArrow(number, f"{kinds},part int,place long"), name)
    count = held.groupBy("part", group).agg(F.count("*").alias("n"))
    ends = count.groupBy("part").agg(F.min(F.struct(group, "n")).alias("first"), F.max(F.struct(group, "n")).alias("last"))
    carries, before, carry = [], None, 0
    for r in ends.orderBy("part").collect():
        carry = carry if before is not None and before[0] == r.first[0] else 0
        carries.append((r.part, r.first[0], carry))
        carry = r.last[1] + (carry if r.first[0] == r.last[0] else 0)
        before = (r.last[0],)
    if not carries:
        return held.select(*rows.columns, F.col("place").alias("pos"))
    kind = dict(rows.dtypes)[group]
    table = held.sparkSession.createDataFrame(carries, f"part int, head {kind}, carry long")
    own = F.when(F.col(group).eqNullSafe(F.col("head")), F.col("carry")).otherwise(0)
    return held.join(F.broadcast(table), "part").select(*rows.columns, (F.col("place") + own).alias("pos"))


def _blocks(nodes: DataFrame, extra: list[str], name: str, height: int) -> DataFrame:
    """(grp, block, size, digests, top, and the extra columns as lists) of aligned blocks of ``nodes(grp, pos, digest, ...)``."""
    kinds = dict(nodes.dtypes)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def put(rows: pa.Table) -> pa.RecordBatch:
            leaves = rows.column("digest").to_pylist()
            block = rows.column("block")[0].as_py()
            top = _levels(block, b"".join(leaves), height)[1][-1][0]
            columns = [rows.column("grp").slice(0, 1).combine_chunks(), pa.array([block]), pa.array([len(leaves)]), pa.array([b"".join(leaves)]), pa.array([top])]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(leaves)], pa.int32()), rows.column(c).combine_chunks()) for c in extra]
            return pa.RecordBatch.from_arrays([*columns, *lists], ["grp", "block", "size", "digests", "top", *extra])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held)
            pos, block = rows.column("pos").to_numpy(), rows.column("block").to_numpy()
            # A new block begins where the block or the group changes; places start anew with each group.
            heads = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (pos[1:] <= pos[:-1])))
            for a, b in zip(heads, heads[1:]):
                yield put(rows.slice(a, b - a))
            held = rows.slice(heads[-1]).to_batches()
        if held:
            yield put(pa.Table.from_batches(held))

    rows = nodes.withColumn("block", F.shiftright("pos", height)).select("grp", "pos", "block", "digest", *extra)
    dealt = rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "pos")
    lists = "".join(f", {c} array<{kinds[c]}>" for c in extra)
    return stash(dealt.mapInArrow(pack, f"grp {kinds['grp']}, block long, size long, digests binary, top binary{lists}"), name)


def _layers(nodes: DataFrame, extra: list[str], name: str, height: int) -> list[DataFrame]:
    """Block tables from the leaves up, until every group has one block."""
    out = [_blocks(nodes, extra, name, height)]
    while not out[-1].filter("block > 0").isEmpty():
        out.append(_blocks(out[-1].select("grp", F.col("block").alias("pos"), F.col("top").alias("digest")), [], name, height))
    return out


def _children(blocks: DataFrame, paths: DataFrame | None, height: int) -> DataFrame:
    """(grp, pos, path, inner): the path to the root of every node of a layer, from its block's own path; its first
    ``inner`` bytes lead to the root of the group."""
    kind = dict(blocks.dtypes)["grp"]

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, digests, path, inner = (batch.column(c)[i].as_py() for c in range(1, 5))
                leaves, levels = _levels(block, digests, height)
                n = len(leaves)
                grp = batch.column(0).slice(i, 1).take(pa.array(np.zeros(n, np.int64)))
                found = [path_of(levels, k) + path for k in range(n)]
                longer = np.full(n, inner + STEP * (len(levels) - 1), np.int32)
                yield pa.RecordBatch.from_arrays([grp, pa.array((block << height) + np.arange(n)), pa.array(found), pa.array(longer)], ["grp", "pos", "path", "inner"])

    rows = blocks.select("grp", "block", "digests")
    rows = rows.withColumns({"path": F.lit(b""), "inner": F.lit(0)}) if paths is None else _with_path(rows, paths)
    return rows.select("grp", "block", "digests", "path", "inner").mapInArrow(descend, f"grp {kind}, pos long, path binary, inner int")


def _levels(block: int, digests: bytes, height: int) -> tuple[list[bytes], list[list[bytes]]]:
    # A first block that is not full is the group's only one; a full one is a complete tree in either case.
    leaves = [digests[k : k + 32] for k in range(0, len(digests), 32)]
    return leaves, grow(leaves, block > 0 or len(leaves) == 1 << height, height)


def _with_path(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    up = paths.select(F.col("grp").alias("g"), F.col("pos").alias("p"), "path", "inner")
    return blocks.join(up, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("p"))).drop("g", "p")


def manifest(docs: DataFrame, leaf: Column, changed: Column, group: Column, id_col: str = "doc_id", height: int = HEIGHT) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (hex digests, and whether the folded root is the root).

    ``leaf`` is the hex digest of a row, ``changed`` that of its tampered version (null: not tampered), ``group`` names its
    subtree. Within a group leaves ascend by id (long), null ids first, rows of equal id by their digest; equal rows
    take places next to each other. Groups ascend bytewise, null first. The proof digests the siblings from the leaf to
    the root. No rows give no rows. Other columns are ignored.
    """
    columns = [F.col(f"`{id_col}`").cast("long").alias("doc_id"), group.alias("grp"), F.unhex(leaf).alias("digest"), F.unhex(changed).alias("changed")]
    rows = stash(docs.select(*columns, F.monotonically_increasing_id().alias("rid")), "leaves")
    leaves = numbered(rows, "grp", ["doc_id", "digest", "rid"], "numbered").drop("rid")
    lower = _layers(leaves, ["doc_id", "changed"], "blocks", height)
    # The roots of the groups are the leaves of one more tree.
    roots = lower[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("own"), F.col("top").alias("digest"))
    roots = numbered(roots, "grp", ["own"], "roots")
    upper = _layers(roots.select("grp", "pos", "digest"), [], "groups", height)
    top = upper[-1].select("top").first()
    root = top.top if top else b""

    paths = None
    for blocks in reversed(upper):
        paths = _children(blocks, paths, height)
    # From places in the tree of groups to the groups themselves: each has one block on its last layer.
    up = paths.select("pos", "path")
    paths = roots.join(up, "pos").select(F.col("own").alias("grp"), F.lit(0).cast("long").alias("pos"), "path", F.lit(0).alias("inner"))
    paths = stash(paths, "paths")
    for blocks in reversed(lower[1:]):
        paths = stash(_children(blocks, paths, height), "paths")

    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, digests, path, inner, ids, versions = (batch.column(c)[i].as_py() for c in range(6))
                leaves, levels = _levels(block, digests, height)
                subroot = climb(levels[-1][0], path[:inner]).hex()
                rows = []
                for k, (doc, own, version) in enumerate(zip(ids, leaves, versions)):
                    full = path_of(levels, k) + path
                    folded = climb(version or own, full)
                    rows.append((doc, own.hex(), subroot, root.hex(), proof(full).hex(), folded.hex(), folded == root))
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    blocks = _with_path(lower[0].select("grp", "block", "digests", "doc_id", "changed"), paths)
    return blocks.select("block", "digests", "path", "inner", "doc_id", "changed").mapInArrow(
        unfold, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )


def document_manifest(docs: DataFrame, every: int = 7, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The manifest of documents by language; where ``every`` divides the CRC-32 of the id, a version has one character more.

    Null fields are hashed as such; a null count stays null in the version, which then equals the original. A row
    without id has no version.
    """
    values = [F.col(f"`{f}`") for f in fields]
    more = [(v.cast("decimal(20,0)") + 1) if f == "n_chars" else v for f, v in zip(fields, values)]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return manifest(docs, leaf_of(values), F.when(tampered, leaf_of(more)), F.col("lang").cast("string"))
