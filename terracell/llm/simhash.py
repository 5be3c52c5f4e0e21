"""Near-duplicates by SimHash, found with BK-trees.

Fingerprints that differ in at most ``radius`` bits agree on at least one of ``radius + 1`` bands of bits, so each
distinct fingerprint goes to one shard per band. A task plants the BK-trees of all its shards at once, level by
level in numpy: an element hangs below its parent under the integer Hamming distance of the two. A search
follows only edges whose distance lies within the radius of the searcher's own distance to the node. Each shard
hands on a forest (fingerprint, smallest fingerprint linked to it in the shard), never its pairs.

More distinct fingerprints on one band than a tree may hold are no longer told apart by Hamming trees. They are
met half-way instead: two fingerprints at most two bits apart share a word one bit from either (or one of
the two), so linking the at most 65 fingerprints around every such word is exact and bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import stash, text_blocks
from terracell.llm.components import components

WORDS = 3
RADIUS = 2
SEED = 42
# Fingerprints of one tree at most, and of the trees that a task plants at once.
TREE = 512
FOREST = 1 << 16


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the lower-cased (A-Z) word shingles; a bit is set if over half the shingles' hashes have it."""
    split = text.lower().split()
    if not split:
        return 0
    digest, out = xxhash.xxh64_digest, np.zeros(64, np.int64)
    n = max(1, len(split) - words + 1)
    for at in range(0, n, 1 << 14):
        part = split[at : min(at + (1 << 14), n) + words - 1]
        shingles = zip(*(part[k:] for k in range(words))) if len(part) >= words else [part]
        raw = b"".join([digest(s, SEED) for s in map(b" ".join, shingles)])
        out += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * out > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, text_hash) of every row; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches):
            found = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), batch.column(2)], ["doc_id", "fp", "text_hash"])

    text = F.col(text_col).cast("string")
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return chosen.mapInArrow(run, "doc_id long, fp long, text_hash long")


class Forest:
    """BK-trees of consecutive shards of distinct 64-bit words."""

    def __init__(self, shard: np.ndarray, word: np.ndarray):
        self.word = word
        begins = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.empty(0, np.int64)
        self.root = np.repeat(begins, np.diff(np.append(begins, len(shard))))
        here = np.flatnonzero(self.root != np.arange(len(word)))
        above = self.root[here]
        codes, nodes = [], []
        while len(here):
            code = above * 128 + np.bitwise_count(word[here] ^ word[above]).astype(np.int64)
            order = np.argsort(code, kind="stable")
            here, code = here[order], code[order]
            first = np.append(True, code[1:] != code[:-1])
            codes.append(code[first])
            nodes.append(here[first])
            above = np.repeat(here[first], np.diff(np.append(np.flatnonzero(first), len(here))))[~first]
            here = here[~first]
        code = np.concatenate([np.empty(0, np.int64), *codes])
        order = np.argsort(code)
        self.code, self.node = code[order], np.concatenate([np.empty(0, np.int64), *nodes])[order]

    def pairs(self, radius: int, step: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (searcher, earlier node) at most ``radius`` apart, for ``step`` searchers at a time."""
        for begin in range(0, len(self.word), step):
            who = np.arange(begin, min(begin + step, len(self.word)))
            at = self.root[who]
            while len(who):
                d = np.bitwise_count(self.word[who] ^ self.word[at]).astype(np.int64)
                hit = (d <= radius) & (at < who)
                if hit.any():
                    yield who[hit], at[hit]
                low = np.searchsorted(self.code, at * 128 + np.maximum(d - radius, 0))
                high = np.searchsorted(self.code, at * 128 + d + radius, "right")
                n = high - low
                # Children stand after their parent, so a searcher has no earlier node below a later one.
                n[at >= who] = 0
                who, low, n = who[n > 0], low[n > 0], n[n > 0]
                at = self.node[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
                who = np.repeat(who, n)

    def links(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, first word of its group) of every word linked to an earlier one of its shard."""
        up = np.arange(len(self.word))
        for a, b in self.pairs(radius):
            while True:
                x, y = up[a], up[b]
                if (x == y).all():
                    break
                np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
                while (up[up] != up).any():
                    up = up[up]
        linked = up != np.arange(len(up))
        return self.word[linked], self.word[up[linked]]


def _bands(fp: Column, n: int, radius: int) -> Column:
    """Shard keys of a fingerprint: one for every choice of ``n - radius`` of its ``n`` bands."""
    edges = [64 * i // n for i in range(n + 1)]
    masks = [sum((1 << edges[i + 1]) - (1 << edges[i]) for i in c) for c in combinations(range(n), n - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return F.array(*[F.struct(F.lit(k).alias("band"), fp.bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(signed)])


def _tree_links(shards: DataFrame, radius: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3, 0), np.int64)

        def grow(rows: np.ndarray) -> pa.RecordBatch:
            change = np.append(True, (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1]))
            a, b = Forest(np.cumsum(change), rows[2].view(np.uint64)).links(radius)
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            held = np.concatenate([held, np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])], axis=1)
            if held.shape[1] >= FOREST:
                # The last shard may go on in the next batch.
                last = np.flatnonzero((held[0] != held[0, -1]) | (held[1] != held[1, -1]))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield grow(held[:, :cut].copy())
                    held = held[:, cut:]
        if held.shape[1]:
            yield grow(held.copy())

    dealt = shards.repartition("band", "bits").sortWithinPartitions("band", "bits", "fp").select("band", "bits", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def _midway_links(crowd: DataFrame) -> DataFrame:
    """Links between words at most two bits apart, through the words between them."""
    flips = [F.col("fp").bitwiseXOR(F.lit((1 << k) - (1 << 64 if k == 63 else 0))) for k in range(64)]
    around = crowd.select("fp", F.explode(F.array(F.col("fp"), *flips)).alias("mid"))
    met = around.groupBy("mid").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b")).filter("a <> b").distinct()


def link_fingerprints(distinct: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """(fp, label) of every fingerprint of ``distinct(fp)`` that has another within ``radius``; label is its component."""
    if not 1 <= radius <= 2:
        raise ValueError("radius must be 1 or 2")
    # Enough bands that a shard of unrelated fingerprints stays small.
    n, total = radius + 1, distinct.count()
    while n < 8 and total >> (64 * (n - radius) // n) > 64:
        n += 1
    shards = distinct.select("fp", F.inline(_bands(F.col("fp"), n, radius)))
    crowded = stash(shards.groupBy("band", "bits").count().filter(F.col("count") > tree).select("band", "bits"), "crowded")
    if crowded.isEmpty():
        return components(_tree_links(shards, radius))
    crowd = shards.join(crowded, ["band", "bits"], "left_semi").select("fp").distinct()
    rest = shards.join(crowded, ["band", "bits"], "left_anti")
    return components(_tree_links(rest, radius).union(_midway_links(crowd)))


def nodes(rows: DataFrame) -> DataFrame:
    """(fp, best, n) of the distinct fingerprints of ``rows(doc_id, fp, text_hash)``; best is the row that comes first:
    with an id before without, then the smallest id, then the least text hash."""
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    return stash(rows.groupBy("fp").agg(F.min(row).alias("best"), F.count("*").alias("n")), "distinct")


def _labelled(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, fp, text_hash), and (fp, best, n, label) of the distinct fingerprints."""
    rows = stash(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = nodes(rows)
    labels = link_fingerprints(distinct.select("fp")).withColumnRenamed("node", "fp")
    return rows, distinct.join(labels, "fp", "left").select("fp", "best", "n", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links of at
    most two bits, its own included), n_docs of the component.

    Null, empty and blank texts have fingerprint zero, which links like any other. Repeated rows each give a row and
    link to each other. A null id stays null and never names a component, unless it has no other id (null). No
    rows give no rows, other columns are ignored.
    """
    rows, labelled = _labelled(docs, id_col, text_col)
    groups = labelled.groupBy("label").agg(F.min("best").getField("id").alias("component_id"), F.sum("n").alias("n_docs"))
    named = labelled.select("fp", "label").join(groups, "label").select("fp", "component_id", "n_docs")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_docs")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, that of the smallest id, with the columns of ``docs``.

    Of rows that share the smallest id the one with the least text hash stays, and one of rows equal in both. Rows
    without id stay only where their whole component has none.
    """
    rows, labelled = _labelled(docs, id_col, text_col)
    groups = labelled.groupBy("label").agg(F.min("best").alias("one"), F.sum("n").alias("total")).filter("total > 1")
    several = labelled.select("fp", "label").join(groups, "label").select("fp", "one")
    # What goes is told by id and text; only repeated rows of the one that stays need another look.
    mates = rows.join(several, "fp").groupBy("doc_id", "text_hash").agg(F.first("one").alias("one"), F.count("*").alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("one.id")) & (F.col("text_hash") == F.col("one.hash"))
    told = stash(mates.filter(~stays | (F.col("n") > 1)).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), stays.alias("again")), "told")
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.col(f"`{id_col}`").cast("long").alias("own"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("own_hash"))
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash"))
    # Told rows grow with the input, so they are never broadcast, whatever their number.
    out = keyed.hint("merge").join(told, same, "left_anti").select("row")
    again = told.filter("again")
    if not again.isEmpty():
        out = out.union(keyed.join(again, same).groupBy("id", "hash").agg(F.first("row").alias("row")).select("row"))
    return out.select("row.*")
