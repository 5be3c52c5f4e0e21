"""Toxicity scores by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the hashed words, word pairs, and pairs with one word between, each once. Learning is FTRL-proximal:
every coordinate has its own rate, and the L1 term keeps all but the telling coordinates at exactly zero, so the
weights are few and small enough to broadcast. It runs in rounds over a bounded sample of labelled rows: the
shards learn from the same state side by side, and the next state is the mean of theirs.

Scores come from the text alone; source, language and ids are never features.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import stash, text_blocks
from terracell.llm.repeats import U64, scramble

EDGE = re.compile(r"^[\W_]+|[\W_]+$")
CACHED = 300_000


@dataclass(frozen=True)
class Settings:
    """``bits`` of the feature space; rate (alpha, beta), L1 and L2 of the learner; ``most`` labelled rows are learnt from, in
    ``shards`` for ``rounds`` rounds."""

    bits: int = 18
    alpha: float = 6.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.0
    most: int = 30_000
    shards: int = 4
    rounds: int = 5


class Features:
    """Hashed features of blocks of texts; hashes of words are kept while a task runs."""

    def __init__(self, bits: int):
        self.bits = bits
        self.known: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) pairs, each once, sorted."""
        split = [t.split() for t in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        for w in {w for words in split for w in words}.difference(self.known):
            plain = EDGE.sub("", w.decode("utf-8", "replace").lower())
            self.known[w] = xxhash.xxh64_intdigest(plain) | 1 if plain else 0
        n = [len(words) for words in split]
        word = np.fromiter((self.known[w] for words in split for w in words), U64, sum(n))
        text = np.repeat(np.arange(len(texts)), n)
        text, word = text[word > 0], word[word > 0]
        parts = [(text, word)]
        for gap in (1, 2):
            same = text[gap:] == text[:-gap]
            pair = word[:-gap] * U64(0x9E3779B97F4A7C15) + scramble(word[gap:] + U64(gap))
            parts.append((text[gap:][same], pair[same]))
        keys = [(t.astype(np.int64) << self.bits) | (scramble(h) >> U64(64 - self.bits)).astype(np.int64) for t, h in parts]
        found = np.unique(np.concatenate(keys))
        return found >> self.bits, found & ((1 << self.bits) - 1)


class Learner:
    """FTRL-proximal state: ``z`` and ``n`` of every coordinate, the bias last."""

    def __init__(self, settings: Settings, z: np.ndarray, n: np.ndarray):
        self.s, self.z, self.n = settings, z, n
        self.seen = np.zeros(len(z), bool)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.s, self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, s.l1)
        slope = (s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / slope)

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, len(self.z) - 1)
        w = self.weights(at)
        g = _sigmoid(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + g * g
        self.seen[at] = True


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


def _lesson(state: Broadcast, settings: Settings) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What one shard makes of the state."""

    def learn(shard: pd.DataFrame) -> pd.DataFrame:
        learner = Learner(settings, *(x.copy() for x in state.value))
        for features, label in shard.sort_values(["place", "label"])[["features", "label"]].itertuples(index=False):
            learner.learn(np.asarray(features, np.int64), label)
        at = np.flatnonzero(learner.seen)
        return pd.DataFrame({"shard": shard["shard"].iloc[0], "feature": at, "z": learner.z[at], "n": learner.n[at]})

    return learn


def train(examples: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray, float]:
    """(features, weights, bias) from ``examples(id, text, label)``, which the caller bounds.

    The driver sees at most ``shards`` * 2 ** ``bits`` coordinates a round. No examples give no weights and a bias of 0.
    """
    size = (1 << settings.bits) + 1

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(settings.bits)
        for batch, texts in text_blocks(batches, 2):
            text, feature = features(texts)
            ends = np.searchsorted(text, np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(feature.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, batch.column(3)], ["shard", "place", "features", "label"])

    place = F.xxhash64("id", "text")
    rows = examples.select(F.pmod(place, F.lit(settings.shards)).cast("int").alias("shard"), place.alias("place"), "text", F.col("label").cast("int").alias("label"))
    rows = stash(rows.mapInArrow(extract, "shard int, place long, features array<int>, label int"), "examples")
    spark = examples.sparkSession
    z, n = np.zeros(size), np.zeros(size)
    for _ in range(settings.rounds):
        state = spark.sparkContext.broadcast((z, n))
        told = rows.groupBy("shard").applyInPandas(_lesson(state, settings), "shard int, feature long, z double, n double").toArrow()
        # Untouched coordinates of a shard are as they were. Sums are taken in the order of shards, so reruns agree.
        shard, feature = told.column("shard").to_numpy(), told.column("feature").to_numpy()
        sums = [settings.shards * x for x in (z, n)]
        for k in np.unique(shard):
            at = feature[shard == k]
            for total, old, new in zip(sums, (z, n), (told.column(c).to_numpy()[shard == k] for c in ("z", "n"))):
                total[at] += new - old[at]
        z, n = (x / settings.shards for x in sums)
        state.unpersist()
    weights = Learner(settings, z, n).weights(np.arange(size))
    at = np.flatnonzero(weights[:-1])
    return at.astype(np.int32), weights[at], float(weights[-1])


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], bits: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = shared.value
        weights = np.zeros(1 << bits)
        weights[at] = values
        features = Features(bits)
        for batch, texts in text_blocks(batches):
            text, feature = features(texts)
            total = bias + np.bincount(text, weights[feature], len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_sigmoid(total))], ["doc_id", "score"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "doc_id long, score double")


def held_out(doc: Column) -> Column:
    """Rows whose labels are never learnt from; a null id is held out."""
    return F.coalesce(F.crc32(doc.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def toxicity(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.7,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold).

    Learns from about ``settings.most`` labelled rows at most, chosen by a hash of the id, none of them held out.
    Labels that are null or repeated for an id count as one (the highest). Null and empty texts have the bias's score; without
    any labels all scores are 0.5. Repeated rows each give a row, no rows give no rows, other columns are ignored.
    """
    labelled = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IS NOT NULL")
    labelled = labelled.filter(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    total = labelled.count()
    if total > settings.most:
        labelled = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(settings.most / total * (1 << 20)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The sample has a stated bound, so it may be broadcast; the rows of one id are learnt from once.
    examples = texts.join(F.broadcast(labelled), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    model = train(examples, settings)
    doc = F.col("doc_id")
    return score(docs, model, settings.bits, id_col, text_col).select(
        doc, held_out(doc).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
