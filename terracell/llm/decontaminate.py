"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel distance.

A test item of m characters may differ from a passage in ``budget`` = m * ``rate`` edits. Cut into budget + 1 pieces,
one piece at least must then stand unchanged in the passage, near the place where it would be. One Aho-Corasick
automaton finds the pieces of all items in one walk over a text; each hit names a window of the text, and the
least edit distance between the item and any passage in that window decides.

Items and texts are compared in lower case and with white space runs as one blank. An item of fewer than ``PHRASE``
words is looked for as it is, between blanks or the ends of the text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terracell.llm.common import text_blocks

RATE = 0.05
# Items of fewer words stand for an exact phrase: no edits, and on word bounds.
PHRASE = 5
# Bytes of test items that are broadcast at once; more are taken in further passes.
ITEMS = 16 << 20


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): the item in budget + 1 parts of near equal length."""
    edges = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(pattern_masks: dict[str, int], m: int, text: str, most: int) -> tuple[int, int] | None:
    """(distance, end) of the nearest passage of ``text`` if within ``most`` edits; the first end among equals."""
    every, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = every, 0, m, None
    for end, ch in enumerate(text, 1):
        eq = pattern_masks.get(ch, 0)
        x = eq | minus
        d0 = ((((x & plus) + plus) ^ plus) | x) & every
        hp, hn = minus | (every & ~(plus | d0)), plus & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        if score <= most and (best is None or score < best[0]):
            best = (score, end)
        # The passage may begin anywhere, so row 0 stays 0.
        hp, hn = (hp << 1) & every, (hn << 1) & every
        plus, minus = hn | (every & ~(hp | d0)), hp & d0
    return best


class Finder:
    """The automaton over the pieces of a block of items, and the verification."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = items
        self.phrase = [t.count(" ") < PHRASE - 1 for _, t in items]
        self.budget = [0 if p else math.floor(len(t) * rate) for (_, t), p in zip(items, self.phrase)]
        self.masks: dict[int, dict[str, int]] = {}
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (_, item) in enumerate(items):
            for offset, piece in pieces(item, self.budget[i]):
                places.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def matches(self, text: str, first_only: bool = False) -> dict[int, tuple[int, int]]:
        """Least distance, and the end of that passage, for each item (by place) found in a normalised text."""
        found: dict[int, tuple[int, int]] = {}
        tried: set[tuple[int, int]] = set()
        if not self.any:
            return found
        for last, (size, where) in self.automaton.iter(text):
            for i, offset in where:
                if found.get(i, (1, 0))[0] == 0:
                    continue
                k, m = self.budget[i], len(self.items[i][1])
                begin = last + 1 - size - offset
                if self.phrase[i]:
                    if (not begin or text[begin - 1] == " ") and text[last + 1 : last + 2] in ("", " "):
                        found[i] = (0, last + 1)
                        if first_only:
                            return found
                    continue
                # Hits whose windows begin in the same stretch share one, wide enough for all of them.
                stretch = begin // (2 * k + 1)
                if (i, stretch) in tried:
                    continue
                tried.add((i, stretch))
                low = max(0, stretch * (2 * k + 1) - k)
                near = myers(self._masks(i), m, text[low : (stretch + 1) * (2 * k + 1) + m + k], k)
                if near and (i not in found or near[0] < found[i][0]):
                    found[i] = (near[0], low + near[1])
                    if first_only:
                        return found
        return found

    def _masks(self, i: int) -> dict[str, int]:
        if i not in self.masks:
            masks: dict[str, int] = {}
            for at, ch in enumerate(self.items[i][1]):
                masks[ch] = masks.get(ch, 0) | 1 << at
            self.masks[i] = masks
        return self.masks[i]


@lru_cache(maxsize=1)
def _finder(items: tuple[tuple[int, str], ...], rate: float) -> Finder:
    return Finder(list(items), rate)


def item_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", min_words: int = 1, most_bytes: int = ITEMS) -> Iterator[Broadcast]:
    """Normalised items, dealt by hash into broadcasts of about ``most_bytes``."""
    spark = benchmark.sparkSession
    chosen = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).dropDuplicates()
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // most_bytes)
    for b in range(n):
        rows = chosen.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).collect()
        items = tuple((r.item, t) for r in rows if r.text is not None and len((t := normal(r.text)).split()) >= max(1, min_words))
        if items:
            yield spark.sparkContext.broadcast(items)


def leaks(
    docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_words: int = 1,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, distance, item_chars, end) for every row of ``docs`` that holds a passage within ``rate`` * length
    edits of a test item: its least distance, and where that passage first ends in the normalised text.

    Items of fewer than ``PHRASE`` words are found without edits only, and between word bounds. Null items and those of fewer
    than ``min_words`` words (one unless told otherwise) are not looked for; equal items count once. Null and empty texts hold nothing. Repeated rows each give their rows, null ids stay
    null, an empty table on either side gives no rows, other columns are ignored. Whole texts are searched.
    """
    names = ["doc_id", "item_id", "distance", "item_chars", "end"]
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def search(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _finder(shared.value, rate)
            for batch, texts in text_blocks(batches):
                rows: list[tuple] = []
                for doc, text in zip(batch.column(0).to_pylist(), texts):
                    for i, (distance, end) in sorted(finder.matches(normal(text.decode("utf-8", "replace"))).items()):
                        rows.append((doc, finder.items[i][0], distance, len(finder.items[i][1]), end))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

        return chosen.mapInArrow(run, ", ".join(f"{n} long" for n in names))

    found = [search(b) for b in item_blocks(benchmark, item_col, item_text_col, min_words)]
    out = docs.sparkSession.createDataFrame([], ", ".join(f"{n} long" for n in names)) if not found else found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_words: int = 1, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their own columns. Nothing is shuffled. ``min_words`` spares
    documents from test items that are no more than common words."""
    at = docs.columns.index(text_col)

    def without(kept: DataFrame, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _finder(shared.value, rate)
            for batch, texts in text_blocks(batches, at):
                yield batch.filter(pa.array([not finder.matches(normal(t.decode("utf-8", "replace")), True) for t in texts], pa.bool_()))

        return kept.mapInArrow(run, StructType(docs.schema.fields))

    for shared in item_blocks(benchmark, min_words=min_words):
        docs = without(docs, shared)
    return docs
