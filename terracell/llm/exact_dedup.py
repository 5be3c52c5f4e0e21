"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Every part of the documents (the rows of one task) sorts the short fingerprints of its texts and sends each range of
them to the range's owner, as Golomb codes of the gaps. An owner answers with one bitmap a part: which of the part's
fingerprints another part has too. Parts turn the answers into a bitmap over their own rows, in which fingerprints
that meet within the part are marked as well. Only marked rows, the suspects, are shuffled with their texts and grouped
by the texts' bytes; copies meet a map-side combine, so a large group sends one row a task.

The width of the fingerprints follows the number of documents: a row without copy is a suspect once in about a
thousand. That costs a comparison and never changes a result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import scratch_path, stash

# Bits of a fingerprint beyond those that number the documents, and fingerprints that an owner should meet.
SPARE = 10
OWNED = 1 << 20

# Runs of white space that are not a single space already.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def encode(values: np.ndarray) -> tuple[int, bytes]:
    """Sorted distinct whole numbers as Golomb codes of their gaps, with a divisor of 2**k: k, and the quotients in
    unary followed by the remainders of k bits."""
    gaps = np.diff(values, prepend=0)
    k = max(0, int(np.log2(max(1.0, float(gaps.mean()) * 0.69)))) if len(gaps) else 0
    high, low = gaps >> k, gaps & ((1 << k) - 1)
    ends = np.cumsum(high + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    rest = (low[:, None] >> np.arange(k)) & 1
    return k, np.packbits(np.concatenate([unary, rest.astype(np.uint8).ravel()])).tobytes()


def decode(code: bytes, n: int, k: int) -> np.ndarray:
    """The numbers that ``encode`` was given."""
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    # The first n ones end the quotients; remainders take the n * k bits behind the last of them.
    ends = np.flatnonzero(bits)[:n]
    high = np.diff(ends, prepend=-1) - 1
    begin = int(ends[-1]) + 1 if n else 0
    rest = bits[begin : begin + n * k].reshape(n, k).astype(np.int64)
    return np.cumsum((high << k) + (rest << np.arange(k)).sum(axis=1))


def _part_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, places, fingerprints) of whole parts from rows (part, place, mark) sorted by part."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
        cuts = np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1
        for piece in np.split(rows, cuts, axis=1):
            if piece.shape[1] and held and held[0][0, 0] != piece[0, 0]:
                whole = np.concatenate(held, axis=1)
                yield int(whole[0, 0]), whole[1], whole[2]
                held = []
            if piece.shape[1]:
                held.append(piece)
    if held:
        whole = np.concatenate(held, axis=1)
        yield int(whole[0, 0]), whole[1], whole[2]


SENT = "part long, owner long, n int, k int, code binary"
ANSWER = "part long, owner long, n int, bits binary"


def _send(marks: DataFrame, shift: int) -> DataFrame:
    """Rows SENT: each part's distinct fingerprints, one coded list an owner. The owner is what stands above ``shift`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, mark in _part_lists(batches):
            own = np.unique(mark)
            owner = own >> shift
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lists = np.split(own & ((1 << shift) - 1), heads[1:])
            codes = [encode(x) for x in lists]
            columns = [np.full(len(lists), part), owner[heads], np.array([len(x) for x in lists], np.int32), np.array([k for k, _ in codes], np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([c for _, c in codes], pa.binary())], ["part", "owner", "n", "k", "code"])

    return marks.repartition("part").sortWithinPartitions("part", "mark").mapInArrow(run, SENT)


def _answer(sent: DataFrame) -> DataFrame:
    """Rows ANSWER: for each list an owner received, which of its fingerprints came from another part too."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        lists = [decode(code, n, k) for _, _, n, k, code in rows]
        every = np.sort(np.concatenate(lists))
        twice = np.unique(every[1:][every[1:] == every[:-1]])
        bits = [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in lists]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(bits, pa.binary())], ["part", "owner", "n", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][1] != row[1]:
                    yield settle(held)
                    held = []
                held.append(row)
        if held:
            yield settle(held)

    return sent.repartition("owner").sortWithinPartitions("owner", "part").mapInArrow(run, ANSWER)


def _suspects(marks: DataFrame, answers: DataFrame) -> DataFrame:
    """(part, suspect): a bitmap over the places of every part's rows."""

    def run(key: tuple, rows: pa.Table, told: pa.Table) -> pa.Table:
        place, mark = rows.column("place").to_numpy(), rows.column("mark").to_numpy()
        told = told.sort_by("owner")
        bits = [np.unpackbits(np.frombuffer(b, np.uint8))[:n] for b, n in zip(told.column("bits").to_pylist(), told.column("n").to_pylist())]
        own, inverse, count = np.unique(mark, return_inverse=True, return_counts=True)
        hit = (np.concatenate(bits).astype(bool) | (count > 1))[inverse]
        flags = np.zeros(int(place.max()) + 1, bool)
        flags[place] = hit
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "suspect": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    return marks.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(run, "part long, suspect binary")


def _table(rows: DataFrame, buckets: int) -> DataFrame:
    """The rows written in buckets of whole parts, so that what is known of a part meets its rows without moving them."""
    spark = rows.sparkSession
    name = f"exact_{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, "part").option("path", scratch_path(spark, "rows")).saveAsTable(name)
    table = spark.table(name)
    # The files stay; only the name goes.
    spark.sql(f"DROP TABLE {name}")
    return table


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spare: int = SPARE, owned: int = OWNED) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when the same after each run of ASCII white space became one space; a null text counts as empty.
    Of equal texts the row with the smallest id stays, rows without id come last; of rows that tie, repeated rows
    among them, exactly one stays. A group without any id has keep_id null. No rows give no rows, other columns are
    ignored. Texts of any length are compared whole.
    """
    spark = docs.sparkSession
    text = F.regexp_replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), RUNS, " ")
    rid = F.monotonically_increasing_id()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), rid.alias("rid"))
    rows = rows.select(
        "doc_id", F.shiftright("rid", 33).alias("part"), F.col("rid").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.xxhash64("text").alias("hash"), "text",
    )
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = _table(rows, buckets)
    n = table.count()
    width = max(1, min(62, n.bit_length() + spare))
    # Owners are told by the upper bits of a fingerprint.
    above = min(width - 1, (n // owned).bit_length())
    marks = table.select("part", "place", F.shiftrightunsigned("hash", 64 - width).alias("mark"))
    answers = stash(_answer(_send(marks, width - above)), "answers")
    flags = stash(_suspects(marks, answers), "suspects")

    byte = F.substring("suspect", (F.col("place") / 8).cast("int") + 1, F.lit(1))
    set_ = F.conv(F.hex(byte), 16, 10).cast("int").bitwiseAND(F.pow(F.lit(2), 7 - F.col("place") % 8).cast("int")) > 0
    flagged = table.join(flags, "part").withColumn("hit", set_)
    alone = flagged.filter("not hit").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"))
    hits = flagged.filter("hit")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "part", "place")
    groups = hits.groupBy("sha", "text").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    # Texts are told apart by their bytes; that equal digests mean equal texts is checked, not assumed.
    once = F.when(F.count("*") == 1, F.min("first")).otherwise(F.raise_error(F.lit("two texts share a digest")).cast("struct<no_id: boolean, doc_id: bigint, part: bigint, place: bigint>"))
    groups = groups.groupBy("sha").agg(once.alias("first"), F.sum("size").alias("size"))
    groups = stash(groups, "groups")
    stays = (F.col("part") == F.col("first.part")) & (F.col("place") == F.col("first.place"))
    several = hits.select("doc_id", "part", "place", "sha").join(groups, "sha")
    several = several.select("doc_id", F.col("first.doc_id").alias("keep_id"), F.col("size").alias("group_size"), stays.alias("kept"), F.col("sha").alias("text_sha256"))
    return alone.union(several)
