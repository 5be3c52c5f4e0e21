"""Exact substring removal by distributed prefix doubling over sampled positions.

A byte goes if some string of ``length`` bytes (a window) that covers it also starts earlier. Prefix doubling ranks
the text at every position by its first h bytes, then by pairs of ranks at distance h, and drops positions whose
rank is unique. Here a rank is a 64-bit name, made in numpy for h = 1, 2, 4 ... 32 by pairing the names h apart.
From 32 bytes on Spark sorts, and only positions that the text itself selects take part:

1. Every window contains one selected position: the least name of its 32-byte strings. Equal windows select
   equal places, so neighbouring windows with one selected position form a run, about one for 35 bytes. Spark
   sorts the runs by (name, hash of the run's whole text, place). A unique name rules the run's windows out; a whole text
   met before settles them all. What is left are the runs where repeats begin or end.
2. Those are halved into windows that share 64 bytes, named by the pair of names 32 apart, and sorted again
   with their text of at most 136 bytes. Unique names are dropped as before.
3. The windows that are left are named by the pair of 64-byte names 36 apart, which passes the threshold. The first of
   equal windows stays, later ones go.

The halves of a name that many different runs share never meet: their windows are sorted by their own names instead.
Texts travel compressed, once to cut out the runs of step 2 and once for the result; all else is rows of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import stash, text_blocks
from terracell.llm.repeats import OCCURRENCE, U64, covered, keyed, lead_of, occurrences, own_id, scramble, settle, stretches, unpacked, with_verdicts

GRAM = 32
# Halves of runs that one task compares at once, and how many of one name; those of a name with more are not gathered.
CHUNK = 1 << 15
CROWD = 2048
# Window starts looked at together.
STEP = 1 << 21

BYTE = scramble(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
BASE = 0xD1342543DE82EF95
PLACES = (1 << 22) - 1


def names(codes: np.ndarray, h: int) -> np.ndarray:
    """Names of the ``h`` bytes at every position, by pairing names of half the length; ``h`` is a power of two."""
    out, width, factor = codes, 1, BASE
    while width < h:
        out = out[:-width] * U64(factor) + out[width:] if len(out) > width else out[:0]
        width, factor = 2 * width, factor * factor % (1 << 64)
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.empty(n, U64)
        p[0] = 1
        done = 1
        while done < n:
            more = min(done, n - done)
            p[done : done + more] = p[:more] * U64(pow(b, done, 1 << 64))
            done += more
        out.append(p)
    return out[0], out[1]


class Spans:
    """Hashes of any stretches of one buffer."""

    def __init__(self, codes: np.ndarray):
        power, self.inverse = _powers(len(codes) + 1)
        self.sums = np.append(U64(0), np.cumsum(codes * power[:-1], dtype=U64))

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows - 1, name, span) of the runs of all texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    found: list[tuple[np.ndarray, ...]] = []
    for begin in range(0, len(buffer), STEP):
        part = buffer[begin : begin + STEP + length - 1]
        if len(part) < length:
            break
        codes = BYTE[part]
        grams = names(codes, GRAM)
        keys = (scramble(grams) & ~U64(PLACES)) | np.arange(len(grams), dtype=U64)
        least, width, most = keys, 1, length - GRAM + 1
        while 2 * width <= most:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        if width < most:
            least = np.minimum(least[: len(least) - (most - width)], least[most - width :])
        chosen = (least & U64(PLACES)).astype(np.int64)
        # Windows within one text, and the text they lie in.
        first = int(np.searchsorted(ends, begin, "right"))
        last = int(np.searchsorted(ends, begin + len(chosen) - 1, "right"))
        own = np.arange(first, min(last, len(texts) - 1) + 1)
        low = np.maximum(ends[own] - sizes[own] - begin, 0)
        high = np.minimum(ends[own] - begin - length + 1, len(chosen))
        own, low, high = own[high > low], low[high > low], high[high > low]
        if not len(own):
            continue
        edge = np.zeros(len(chosen) + 1, bool)
        edge[1:-1] = chosen[1:] != chosen[:-1]
        edge[low] = True
        edge[high] = True
        at = np.flatnonzero(edge)
        inside = np.searchsorted(low, at, "right") - 1
        good = (inside >= 0) & (at < high[np.maximum(inside, 0)])
        stop = np.append(at[1:], len(chosen))
        at, stop, inside = at[good], stop[good], inside[good]
        pick = chosen[at]
        span = Spans(codes)(at, stop - 1 + length) ^ scramble((pick - at).astype(U64) << U64(32) | (stop - at).astype(U64))
        text = own[inside]
        found.append((text, at + begin - (ends - sizes)[text], stop - at - 1, scramble(grams[pick]), scramble(span)))
    if not found:
        return tuple(np.empty(0, k) for k in (np.int64, np.int64, np.int64, U64, U64))
    return tuple(np.concatenate(c) for c in zip(*found))


def _run_rows(texts: DataFrame, length: int) -> DataFrame:
    """Runs as occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in text_blocks(batches, 2):
            text, first, more, name, span = runs(block, length)
            yield occurrences(name, span, batch.column(0).to_numpy()[text], batch.column(1).to_numpy()[text], first, more)

    return texts.mapInArrow(run, OCCURRENCE)


def _halves(texts: DataFrame, opened: DataFrame, length: int) -> DataFrame:
    """(name, doc, twin, first, more, bytes): open runs, halved so that the windows of each share 64 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names_ = ["name", "doc", "twin", "first", "more", "bytes"]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
        rows: list[tuple] = []
        for doc, twin, text, first, more in unpacked(batches):
            spans = [text[f : f + m + length] for f, m in zip(first.tolist(), more.tolist())]
            grams = scramble(names(BYTE[np.frombuffer(b"".join(spans), np.uint8)], GRAM))
            at = 0
            for f, m, span in zip(first.tolist(), more.tolist(), spans):
                # The selected string lies in all windows, so between the last one's start and the first one's end.
                pick = m + int(np.argmin(grams[at + m : at + length - GRAM + 1] & ~U64(PLACES)))
                cut = max(0, min(m + 1, pick - GRAM + 1))
                for a, b, place in ((cut, m, pick), (0, cut - 1, pick - GRAM)):
                    if a <= b:
                        rows.append((_pair(grams[at + place], grams[at + place + GRAM]), doc, twin, f + a, b - a, span[a : b + length]))
                at += len(span)
            if len(rows) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names_)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names_)

    return with_verdicts(texts, opened, "inner").mapInArrow(run, "name long, doc long, twin int, first long, more int, bytes binary")


def _pair(a: np.uint64, b: np.uint64) -> int:
    """The name of two neighbouring strings, as a signed long."""
    pair = (int(a) * BASE + int(b)) % (1 << 64)
    return pair - (1 << 64) if pair >> 63 else pair


def _windows(table: pa.Table, length: int) -> tuple[np.ndarray, ...]:
    """(row, offset, name) of all windows of the rows' bytes; the name pairs those of 64 bytes up to the last ones."""
    data = table.column("bytes").combine_chunks()
    data = data.chunk(0) if isinstance(data, pa.ChunkedArray) else data
    begin = np.frombuffer(data.buffers()[1], np.int32)[data.offset : data.offset + len(data)].astype(np.int64)
    n = table.column("more").to_numpy().astype(np.int64) + 1
    row = np.repeat(np.arange(len(n)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    whole = np.frombuffer(data.buffers()[2], np.uint8)
    half = scramble(names(BYTE[whole], 2 * GRAM))
    at = begin[row] + offset
    window = half[at]
    for step in [*range(2 * GRAM, length - 2 * GRAM, 2 * GRAM), length - 2 * GRAM]:
        window = scramble(window * U64(BASE) + half[at + step])
    return row, offset, window


def _loose(halves: DataFrame, length: int) -> DataFrame:
    """The windows of halves as occurrences of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CROWD):
                table = pa.Table.from_batches([batch.slice(at, CROWD)]).combine_chunks()
                row, offset, window = _windows(table, length)
                name, doc, twin, first = (table.column(c).to_numpy()[row] for c in ("name", "doc", "twin", "first"))
                yield occurrences(window, name.view(U64), doc, twin, first + offset, np.zeros(len(row), np.int32))

    return halves.mapInArrow(run, OCCURRENCE)


def _settle_halves(halves: DataFrame, length: int) -> DataFrame:
    """(doc, twin, first, more): windows that stand earlier too. No name has many halves."""
    columns = ["doc", "twin", "first", "more"]

    def told(table: pa.Table) -> pa.RecordBatch:
        """All halves of the names in ``table`` are in it."""
        name = table.column("name").to_numpy()
        same = np.concatenate([[False], name[1:] == name[:-1], [False]])
        table = table.filter(pa.array(same[1:] | same[:-1])).combine_chunks()
        name, doc, twin, first = (table.column(c).to_numpy() for c in ("name", "doc", "twin", "first"))
        row, offset, window = _windows(table, length) if len(table) else (np.empty(0, np.int64),) * 3
        place, owner = first[row] + offset, doc[row]
        late = np.zeros(len(row), bool)
        if len(row):
            order = np.lexsort((place, owner, window, name[row]))
            lead = order[lead_of(name[row][order], window[order])]
            late[order] = (owner[order] != owner[lead]) | (place[order] != place[lead])
        # Neighbouring windows of one half become one verdict.
        joined = np.concatenate([[False], late[1:] & late[:-1] & (row[1:] == row[:-1]), [False]]) if len(row) else np.zeros(1, bool)
        begin, end = np.flatnonzero(late & ~joined[:-1]), np.flatnonzero(late & ~joined[1:])
        arrays = [doc[row[begin]], twin[row[begin]], place[begin], (end - begin).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            name = held.column("name").to_numpy()
            if len(name) >= CHUNK and name[0] != name[-1]:
                # The last name may go on in the next batch.
                cut = int(np.flatnonzero(name != name[-1])[-1]) + 1
                yield told(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and len(held):
            yield told(held)

    return halves.repartition("name").sortWithinPartitions("name").mapInArrow(run, "doc long, twin int, first long, more int")


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, spans (begin and end of each maximal removed run of bytes), kept (the
    remaining bytes; a cut may fall inside a character).

    Earlier means a smaller id, or the same id and an earlier place; a null id comes last. Rows of the same id are the same
    document, so their equal places do not remove each other. A null text is empty; texts shorter than
    ``length`` lose nothing. No rows give no rows. Other columns are ignored. Matches never cross documents.
    """
    if length < 3 * GRAM - 1:
        raise ValueError(f"length must be at least {3 * GRAM - 1}")
    texts = keyed(docs, id_col, text_col)
    verdicts = stash(settle(_run_rows(texts, length)), "runs")
    places = verdicts.filter("not open").drop("open")
    halves = stash(_halves(texts, verdicts.filter("open"), length), "halves")
    crowded = stash(halves.groupBy("name").count().filter(F.col("count") > CROWD).select("name"), "crowded")
    if crowded.isEmpty():
        places = places.union(_settle_halves(halves, length))
    else:
        places = places.union(_settle_halves(halves.join(crowded, "name", "left_anti"), length))
        loose = _loose(halves.join(crowded, "name", "left_semi"), length)
        places = places.union(settle(loose).filter("not open").drop("open"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.binary()]
        names_ = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
        rows, held = [], 0
        for doc, _, text, first, more in unpacked(batches):
            gone = covered(first, more, length, len(text))
            begin, end = stretches(gone)
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if len(begin) else text
            spans = [{"begin": a, "end": b} for a, b in zip(begin.tolist(), end.tolist())]
            rows.append((own_id(doc), len(text), len(text) - len(kept), spans, kept))
            held += len(kept)
            if len(rows) == 2000 or held > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names_)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names_)

    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"
    return with_verdicts(texts, places).mapInArrow(run, schema)


def removal_report(docs: DataFrame, length: int = 100, **columns: str) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs, length, **columns).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
