"""Telling first from later occurrences over all documents, and bringing the verdicts back to the texts.

An occurrence is a row (name, span, doc, twin, first, more): two hashes that equal content shares, its document, and the
places ``first`` to ``first + more`` it stands for. Occurrences are ordered by (doc, first). ``twin`` tells rows of one id and
different texts apart; it takes no part in the order, so equal places of such rows are not later than each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import text_blocks

U64 = np.uint64
NO_ID = (1 << 63) - 1

OCCURRENCE = "name long, span long, doc long, twin int, first long, more int"
VERDICT = "doc long, twin int, first long, more int, open boolean"


def scramble(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit words."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, twin, text) of all rows; a null id comes after all others."""
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    unique = docs.groupBy(doc).count().filter("count > 1").isEmpty()
    twin = F.lit(0) if unique else F.xxhash64(text).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    return docs.select(doc, twin.alias("twin"), text)


def occurrences(name: np.ndarray, span: np.ndarray, doc: np.ndarray, twin: np.ndarray, first: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
    """Rows of one block. Those that stand earlier in the block too are settled (span null) and get a name of
    their own, so that no content sends more than one row a block to its task."""
    order = np.lexsort((first, doc, span, name))
    late = np.zeros(len(order), bool)
    if len(order):
        lead = order[lead_of(name[order], span[order])]
        late[order] = (doc[order] != doc[lead]) | (first[order] != first[lead])
    name = np.where(late, scramble(doc.view(U64) ^ scramble(first.view(U64))), name)
    columns = [pa.array(name.view(np.int64)), pa.array(span.view(np.int64), mask=late), pa.array(doc), pa.array(twin), pa.array(first), pa.array(more.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["name", "span", "doc", "twin", "first", "more"])


def lead_of(*keys: np.ndarray) -> np.ndarray:
    """For sorted rows, the place of the first row of equal keys."""
    new = np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0))
    heads = np.flatnonzero(new)
    return np.repeat(heads, np.diff(np.append(heads, len(new))))


def settle(rows: DataFrame) -> DataFrame:
    """Verdicts on occurrences: later ones (not open), and first ones whose name has another span too (open).

    All rows of a name meet sorted in one task, which holds one batch and the last first row. A name under
    which nothing else stands gives no rows.
    """
    kinds = (np.int64, np.int32, np.int64, np.int32, bool)

    def batch_of(arrays: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.astype(k)) for x, k in zip(arrays, kinds)], ["doc", "twin", "first", "more", "open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last first row of the name under way, and whether another span of that name came before.
        held, several = None, False
        for batch in batches:
            fresh = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            columns = [batch.column(0).to_numpy(), batch.column(1).fill_null(0).to_numpy(), *(batch.column(i).to_numpy() for i in range(2, 6))]
            settled = [c[~fresh] for c in columns[2:]]
            yield batch_of([*settled, np.zeros(len(settled[0]), bool)])
            name, span, *place = (c[fresh] if held is None else np.append(h, c[fresh]) for c, h in zip(columns, held or [None] * 6))
            if not len(name):
                continue
            lead = lead_of(name, span)
            late = (place[0] != place[0][lead]) | (place[2] != place[2][lead])
            heads = np.unique(lead)
            beside = name[heads[1:]] == name[heads[:-1]]
            is_open = np.append(beside, False) | np.append(several, beside)
            # Rows on the place of their first one are as open as it may be.
            told = late | (lead != np.arange(len(lead)))
            told[heads[:-1]] = is_open[:-1]
            yield batch_of([*(c[told] for c in place), ~late[told]])
            several, last = bool(is_open[-1]), heads[-1]
            held = [c[last : last + 1] for c in (name, span, *place)]
        if several:
            yield batch_of([*held[2:], np.array([True])])

    return rows.repartition("name").sortWithinPartitions("name", "span", "doc", "first").mapInArrow(run, VERDICT)


def with_verdicts(texts: DataFrame, verdicts: DataFrame, how: str = "left") -> DataFrame:
    """(doc, twin, text, first, more): texts, compressed for the way, with the places of their verdicts as arrays.

    Repeated rows share (doc, twin): each of them sends the same verdicts, which are listed once.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch, block in text_blocks(batches, 2):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([tool.compress(t) for t in block], pa.binary())], ["doc", "twin", "text"])

    lists = verdicts.groupBy("doc", "twin").agg(F.collect_set(F.struct("first", "more")).alias("rows"))
    lists = lists.select("doc", "twin", F.col("rows.first").alias("first"), F.col("rows.more").alias("more"))
    return texts.mapInArrow(pack, "doc long, twin int, text binary").join(lists, ["doc", "twin"], how).select("doc", "twin", "text", "first", "more")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray]]:
    """(doc, twin, text, first, more) of the rows of ``with_verdicts``."""
    tool, none = zstandard.ZstdDecompressor(), np.empty(0, np.int64)
    for batch in batches:
        doc, twin, text, *places = batch.columns
        for i in range(batch.num_rows):
            lists = [p[i].values.to_numpy() if p[i].is_valid else none for p in places]
            yield doc[i].as_py(), twin[i].as_py(), tool.decompress(text[i].as_py()), *lists


def covered(first: np.ndarray, more: np.ndarray, width: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie in a stretch of ``width`` that starts at ``first`` to ``first + more``."""
    edge = np.bincount(first, minlength=size + 1) - np.bincount(first + more + width, minlength=size + 1)
    return np.cumsum(edge[:size]) > 0


def stretches(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the maximal runs of true."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def own_id(doc: int) -> int | None:
    return None if doc == NO_ID else doc
