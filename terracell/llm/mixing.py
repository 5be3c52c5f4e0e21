"""Mixing sources to target weights by min-cost flow.

A document may belong to several sources. Documents are summed up by their membership pattern; tokens flow from
patterns to the sources in them, up to every source's target. Taking a pattern's documents again costs more each
time (convex), so repeats are used only where fresh documents cannot fill a target. The flow says how many
tokens each pattern gives; whole passes take all its documents, and the rest of it is taken by
documents in the order of a seeded hash.

Only sums by pattern reach the driver. Documents are told apart by histograms of the hash, refined twice around the
place where a pattern's rest ends, so no pattern's documents are ever sorted or gathered.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracell.llm.common import stash, unstash, word_count
from terracell.llm.components import components

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
# Arcs between patterns and sources that the driver's network may have.
ARCS = 200_000
SLOTS = 4096


class Flow:
    """Max flow from patterns to sources, filled up one repetition cost after the other (Dinic's layers)."""

    def __init__(self, sizes: list[int], members: list[list[int]], quotas: list[int]):
        n = len(sizes)
        self.sizes, self.source, self.sink = sizes, n + len(quotas), n + len(quotas) + 1
        self.to: list[int] = []
        self.room: list[int] = []
        self.arcs: list[list[int]] = [[] for _ in range(self.sink + 1)]
        self.supply = [self._arc(self.source, p, 0) for p in range(n)]
        for p, sources in enumerate(members):
            for s in sources:
                self._arc(p, n + s, 1 << 62)
        for s, quota in enumerate(quotas):
            self._arc(n + s, self.sink, quota)

    def _arc(self, a: int, b: int, room: int) -> int:
        self.arcs[a].append(len(self.to))
        self.arcs[b].append(len(self.to) + 1)
        self.to += [b, a]
        self.room += [room, 0]
        return len(self.to) - 2

    def solve(self, epochs: int) -> list[int]:
        """Tokens taken of each pattern. Costs rise with the epoch alike for all patterns, so a cheapest flow uses every
        path of an epoch before it opens the next; flow already sent is rerouted but never taken back."""
        for _ in range(epochs):
            for arc, size in zip(self.supply, self.sizes):
                self.room[arc] += size
            while self._layers():
                self.next = [0] * len(self.arcs)
                while self._push():
                    pass
        return [self.room[arc ^ 1] for arc in self.supply]

    def _layers(self) -> bool:
        self.depth = [-1] * len(self.arcs)
        self.depth[self.source] = 0
        queue = deque([self.source])
        while queue:
            at = queue.popleft()
            for arc in self.arcs[at]:
                to = self.to[arc]
                if self.room[arc] and self.depth[to] < 0:
                    self.depth[to] = self.depth[at] + 1
                    queue.append(to)
        return self.depth[self.sink] >= 0

    def _push(self) -> int:
        """One path from source to sink, without recursion."""
        path: list[int] = []
        at = self.source
        while at != self.sink:
            while self.next[at] < len(self.arcs[at]):
                arc = self.arcs[at][self.next[at]]
                if self.room[arc] and self.depth[self.to[arc]] == self.depth[at] + 1:
                    break
                self.next[at] += 1
            else:
                if not path:
                    return 0
                arc = path.pop()
                at = self.to[arc ^ 1]
                self.next[at] += 1
                continue
            path.append(arc)
            at = self.to[arc]
        sent = min(self.room[arc] for arc in path)
        for arc in path:
            self.room[arc] -= sent
            self.room[arc ^ 1] += sent
        return sent


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources with their place (from 0) in order of code point, null last, without gathering them in one task."""
    key = F.col("source").isNull(), F.col("source")
    part = F.spark_partition_id()
    cut = sources.repartitionByRange(*key).sortWithinPartitions(*key).withColumns({"part": part, "at": F.monotonically_increasing_id()})
    cut = stash(cut.withColumn("at", F.col("at") - F.shiftleft(F.col("part").cast("long"), 33)), "ranked")
    before, offsets = 0, []
    for r in sorted(cut.groupBy("part").count().collect(), key=lambda r: r.part):
        offsets.append((r.part, before))
        before += r["count"]
    table = sources.sparkSession.createDataFrame(offsets, "part int, before long")
    return cut.join(table, "part").select("source", "source_size", (F.col("before") + F.col("at")).alias("place"))


def source_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size): targets by weight, none above ``epochs`` times its size.

    The excess over a limit is dealt again by weight until none is above, so one level per unit of weight holds
    for all sources below their limit. The level is found from sums, a few rounds of one small job each.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    table = stash(_ranked(sources).select("source", "source_size", weight.alias("weight"), (epochs * F.col("source_size")).alias("most")), "sources")
    wanted = share * (table.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("most") <= F.col("weight") * level
        r = table.agg(F.sum(F.when(full, F.col("most"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        higher = max(0.0, wanted - (r.full or 0)) / r.weight if r.weight else level
        if higher <= level:
            break
        level = higher
    return table.select("source", "source_size", F.least(F.col("weight") * level, F.col("most").cast("double")).alias("target"))


def _shares(patterns: DataFrame, targets: DataFrame, epochs: int) -> DataFrame:
    """(pattern, size, taken): what the cheapest flow takes of each pattern."""
    spark = patterns.sparkSession
    arcs = patterns.select("pattern", "size", F.explode("pattern").alias("source"))
    quotas = targets.select("source", F.round("target").cast("long").alias("quota"))
    arcs = arcs.join(quotas, arcs.source.eqNullSafe(quotas.source)).select("pattern", "size", arcs.source, "quota")
    alone = spark.createDataFrame([], "pattern array<string>, size long, taken long")
    if arcs.count() > ARCS:
        # A source without overlaps is a network of one arc: its flow is known.
        met = arcs.filter(F.size("pattern") > 1).select(F.col("source").alias("met")).distinct()
        alone = arcs.join(met, arcs.source.eqNullSafe(met.met), "left_anti").select("pattern", "size", F.least(epochs * F.col("size"), "quota").alias("taken"))
        arcs = arcs.join(met, arcs.source.eqNullSafe(met.met), "left_semi")
        if arcs.count() > ARCS:
            return _shares_apart(arcs, epochs).union(alone)
    rows = arcs.collect()
    pattern, source = {}, {}
    for r in sorted(rows, key=lambda r: ([(s is None, s or "") for s in r.pattern], r.source is None, r.source or "")):
        pattern.setdefault(tuple(r.pattern), (r["size"], []))[1].append(source.setdefault(r.source, (len(source), r.quota))[0])
    flow = Flow([s for s, _ in pattern.values()], [m for _, m in pattern.values()], [q for _, q in source.values()]).solve(epochs)
    solved = [(list(p), size, taken) for (p, (size, _)), taken in zip(pattern.items(), flow)]
    return spark.createDataFrame(solved, "pattern array<string>, size long, taken long").union(alone)


def _shares_apart(arcs: DataFrame, epochs: int) -> DataFrame:
    """The same where the network is too large for the driver: each of its connected parts is solved in a task of its own."""
    node = F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull())
    met = arcs.select(node.alias("b"), F.xxhash64(F.to_json("pattern")).alias("a"), "pattern", "size", "source", "quota")
    met = stash(met, "network")
    labels = components(met.select("a", "b")).withColumnRenamed("node", "a")

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        key = [tuple(p) for p in part["pattern"]]
        size, members, source, quotas = {}, {}, {}, []
        for p, n, s, quota in sorted(zip(key, part["size"], part["source"], part["quota"]), key=lambda r: ([(s is None, s or "") for s in r[0]], r[2] is None, r[2] or "")):
            if s not in source:
                source[s] = len(quotas)
                quotas.append(int(quota))
            size[p] = int(n)
            members.setdefault(p, []).append(source[s])
        taken = Flow(list(size.values()), [members[p] for p in size], quotas).solve(epochs)
        return pd.DataFrame({"pattern": [list(p) for p in size], "size": list(size.values()), "taken": taken})

    parts = met.join(labels, "a").select("label", "pattern", "size", "source", "quota")
    return parts.groupBy("label").applyInPandas(solve, "pattern array<string>, size long, taken long")


def _picks(units: DataFrame, shares: DataFrame) -> DataFrame:
    """(pattern, passes, edge_hash, edge_id, extra, left): documents before the edge but those left out, and
    the extra ones get one more pass."""
    bits = SLOTS.bit_length() - 1
    high = F.shiftright("hash", 63 - bits)
    low = F.shiftright("hash", 63 - 2 * bits).bitwiseAND(F.lit(SLOTS - 1))
    plan = shares.filter("size > 0").select("pattern", F.floor(F.col("taken") / F.col("size")).alias("passes"), (F.col("taken") % F.col("size")).alias("rest"))
    plan = stash(plan, "plan")

    def edge(sums: DataFrame, by: str, keys: list[str]) -> DataFrame:
        """The slot in which a pattern's rest ends, and what is left of the rest there."""
        w = Window.partitionBy("pattern").orderBy(by)
        run = sums.withColumn("upto", F.sum("size").over(w))
        return run.filter((F.col("upto") > F.col("rest")) & (F.col("upto") - F.col("size") <= F.col("rest"))).select(
            "pattern", *keys, (F.col("rest") - F.col("upto") + F.col("size")).alias("rest")
        )

    slot = units.select("pattern", "unit", high.alias("high")).groupBy("pattern", "high").agg(F.sum("unit").alias("size"))
    first = stash(edge(slot.join(plan, "pattern"), "high", ["high"]), "slots")
    near = units.withColumns({"high": high, "low": low}).join(first, ["pattern", "high"])
    slot = near.groupBy("pattern", "high", "low", "rest").agg(F.sum("unit").alias("size"))
    second = stash(edge(slot, "low", ["high", "low"]), "slots")
    # A slot of the second level holds one document in 16 million of its pattern.
    near = units.withColumns({"high": high, "low": low}).join(second, ["pattern", "high", "low"])
    w = Window.partitionBy("pattern").orderBy("hash", "doc_id")
    run = near.withColumn("upto", F.sum("unit").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    past = run.filter(F.col("upto") > F.col("rest")).groupBy("pattern").agg(
        F.min(F.struct("hash", "doc_id", (F.col("rest") - F.col("upto") + F.col("unit")).alias("gap"))).alias("e")
    )
    edges = stash(past.select("pattern", F.col("e.hash").alias("edge_hash"), F.col("e.doc_id").alias("edge_id"), F.col("e.gap").alias("gap")), "edges")

    # What the edge leaves open is filled by trading documents next to it: on either side up to four of each power
    # of two in size.
    near = units.join(edges.filter("gap > 0"), "pattern").withColumn("taken", _before(F.col("doc_id")))
    row = F.struct("hash", "doc_id", "unit")
    few = near.groupBy("pattern", "gap", "taken", F.floor(F.log2("unit")).alias("octave"), F.pmod("hash", F.lit(4)).alias("turn")).agg(
        F.max(row).alias("last"), F.min(row).alias("first")
    )
    few = few.select("pattern", "gap", "taken", F.when(F.col("taken"), F.col("last")).otherwise(F.col("first")).alias("one")).select("pattern", "gap", "taken", "one.*")

    def trade(few: pd.DataFrame) -> pd.DataFrame:
        few = few.sort_values(["unit", "hash", "doc_id"])
        taken = few["taken"].to_numpy(bool)
        chosen = np.array(closest(few["unit"].tolist(), int(few["gap"].iloc[0]) + int(few["unit"][taken].sum())), bool)
        extra, left = (few["doc_id"][m].tolist() for m in (~taken & chosen, taken & ~chosen))
        return pd.DataFrame({"pattern": [few["pattern"].iloc[0]], "extra": [extra], "left": [left]})

    traded = stash(few.groupBy("pattern").applyInPandas(trade, "pattern array<string>, extra array<long>, left array<long>"), "traded")
    out = plan.select("pattern", "passes").join(edges.drop("gap"), "pattern", "left").join(traded, "pattern", "left")
    return stash(out.withColumns({c: F.coalesce(c, F.array().cast("array<long>")) for c in ("extra", "left")}), "picks")


def closest(units: list[int], goal: int, steps: int = 1 << 18) -> list[bool]:
    """Which units to take for the largest sum that does not exceed ``goal``; sums are told apart in ``steps`` steps."""
    scale = max(1, -(-goal // steps))
    sizes, room = [-(-u // scale) for u in units], (1 << (goal // scale + 1)) - 1
    reach = [1]
    for u in sizes:
        reach.append((reach[-1] | reach[-1] << u) & room)
    at, chosen = reach[-1].bit_length() - 1, [False] * len(units)
    for i in range(len(units) - 1, -1, -1):
        if not reach[i] >> at & 1:
            chosen[i] = True
            at -= sizes[i]
    return chosen


def _before(doc: Column) -> Column:
    """Is a document (hash, id) before its pattern's edge?"""
    return F.coalesce((F.col("hash") < F.col("edge_hash")) | (F.col("hash") == F.col("edge_hash")) & (doc < F.col("edge_id")), F.lit(False))


def _hash(doc: Column, seed: int) -> Column:
    """63 bits of a seeded hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc), 1)


def mix(
    docs: DataFrame, sources: Column | str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
    seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(decisions, targets): decisions has the rows of ``docs`` as a struct ``row`` with size, pattern and taken.

    ``sources`` names a column of one source, or of an array of sources (membership; empty counts as one null source).
    taken is a whole number of passes over the document, at most ``epochs``. The sum over a pattern misses the
    flow by less than the small documents next to the edge. Rows of one id and pattern are taken alike, rows
    without id like those of equal text. Texts that are null or without words have size 0 and are never taken. No rows give no
    rows. The same rows in any order and any partitions give the same mix.
    """
    kind = docs.select(sources).schema[0].dataType.simpleString()
    source = F.col(sources) if isinstance(sources, str) else sources
    one = F.array(source.cast("string"))
    if kind.startswith("array"):
        one = F.array_sort(F.array_distinct(source.cast("array<string>")))
        one = F.when(F.size(one) > 0, one).otherwise(F.array(F.lit(None).cast("string")))
    own, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    # Rows without id go by their texts, so that a source that has many of them can still be split.
    doc = F.coalesce(own, F.xxhash64(F.lit(seed), text))
    pattern, size = F.coalesce(one, F.array(F.lit(None).cast("string"))), word_count(text)
    measured = docs.select(doc.alias("doc_id"), pattern.alias("pattern"), size.alias("size"))
    units = measured.filter("size > 0").groupBy("doc_id", "pattern").agg(F.sum("size").alias("unit")).withColumn("hash", _hash(F.col("doc_id"), seed))
    units = stash(units, "units")
    # Sources without a word have no units, but they take part in the order of the weights.
    empty = stash(measured.select("pattern").distinct(), "patterns")
    patterns = empty.join(units.groupBy("pattern").agg(F.sum("unit").alias("size")), "pattern", "left").select("pattern", F.coalesce("size", F.lit(0)).alias("size"))
    patterns = stash(patterns, "patterns")
    sizes = patterns.select(F.explode("pattern").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = stash(source_targets(sizes, weights, share, epochs), "targets")
    picks = _picks(units, _shares(patterns, targets, epochs))
    unstash(units)

    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    keyed = docs.select(row.alias("row"), own.alias("own_id"), doc.alias("doc_id"), pattern.alias("pattern"), size.alias("size"))
    chosen = keyed.withColumn("hash", _hash(F.col("doc_id"), seed)).join(picks, "pattern", "left")
    within = {c: F.coalesce(F.array_contains(c, F.col("doc_id")), F.lit(False)) for c in ("extra", "left")}
    again = (_before(F.col("doc_id")) & ~within["left"]) | within["extra"]
    passes = F.coalesce(F.col("passes"), F.lit(0)) + again.cast("long")
    return chosen.select("row", F.col("own_id").alias("doc_id"), "pattern", "size", F.when(F.col("size") > 0, passes).otherwise(F.lit(0)).alias("passes")), targets


def mix_report(docs: DataFrame, **args) -> DataFrame:
    """Per row of ``docs`` with one source each: doc_id, size, source_size, target, taken (words, repeats counted)."""
    decisions, targets = mix(docs, "source", **args)
    own = decisions.select("doc_id", "size", "passes", F.element_at("pattern", 1).alias("own"))
    return own.join(targets, own.own.eqNullSafe(targets.source)).select(
        "doc_id", F.col("own").alias("source"), "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken")
    )


def mixed(docs: DataFrame, **args) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: left out, once, or repeated, with their own columns."""
    decisions, _ = mix(docs, "source", **args)
    return decisions.filter("passes > 0").select(F.explode(F.array_repeat("row", F.col("passes").cast("int"))).alias("row")).select("row.*")
