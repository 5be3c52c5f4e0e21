"""Hard negatives by Kronecker-packed products.

The components of many candidates are biased to be non-negative and laid side by side in fields of one wide integer,
one such integer per dimension. An anchor's component multiplies all candidates of a dimension at once; the sum over
the dimensions holds every candidate's exact score in its own field. Fields are as wide as the largest score of the
table needs, so they never run into each other.

Anchors come in blocks of bounded size, each broadcast to one pass over all rows. The first pass finds the anchors'
positives, the second, which knows the positives' scores, the negatives within their margins. A task hands on at
most ``keep`` rows for each anchor (or anchor and positive) and block of candidates; a window ranks those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terracell.llm.common import scratch_path, stash

# Anchors of one broadcast: their components take at most ANCHORS x dimensions x 8 bytes.
ANCHORS = 4096
# Candidates packed into one integer, and rows of one task when the table is dealt out.
PACKED = 8192
# Id of rows without one; they come last among equal scores.
NO_ID = (1 << 63) - 1


class Packed:
    """Candidates' vectors, packed by dimension."""

    def __init__(self, vectors: np.ndarray, width: int):
        """``vectors``: whole numbers, candidates x dimensions. ``width``: bytes of a field, 4 or 8."""
        self.n, self.width, self.kind = len(vectors), width, np.dtype(f"<u{width}")
        self.bias = int(-vectors.min(initial=0))
        columns = (vectors + self.bias).T.astype(self.kind, order="C")
        self.fields = [int.from_bytes(column.tobytes(), "little") for column in columns]
        # Lifts every field above zero, as an anchor's components may be negative.
        self.lift = 1 << (8 * width - 1)
        self.lifted = int.from_bytes(np.full(self.n, self.lift, self.kind).tobytes(), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Inner products of all candidates with one anchor of as many dimensions."""
        total = self.lifted
        for a, field in zip(anchor, self.fields):
            if a:
                total += a * field
        raw = np.frombuffer(total.to_bytes(self.n * self.width, "little"), self.kind)
        return (raw ^ self.kind.type(self.lift)).view(f"<i{self.width}").astype(np.int64) - self.bias * sum(anchor)


def field_width(largest: int, dims: int) -> int:
    """Bytes of a field that holds any sum of ``dims`` products of an anchor's and a biased candidate's component."""
    bound = 2 * dims * largest * largest
    if bound >= 1 << 62:
        raise ValueError("scores of these vectors do not fit in a long")
    return 4 if bound < 1 << 31 else 8


def first_of(score: np.ndarray, ids: np.ndarray, at: np.ndarray, keep: int) -> np.ndarray:
    """Of the places ``at`` those of the first ``keep`` rows by falling score, then by id."""
    if len(at) > keep:
        least = np.partition(score[at], len(at) - keep)[len(at) - keep]
        at = at[score[at] >= least]
    return at[np.lexsort((ids[at], -score[at]))[:keep]]


def whole_rows(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: float, relabel: Column | None) -> DataFrame:
    """(rid, id, label, q) of the rows that take part, written as a table: rid tells rows apart, q are whole components."""
    x = F.transform(F.col(f"`{vector_col}`"), lambda v: v.cast("double"))
    chosen = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    chosen = chosen.filter(F.col("label").isNotNull() & F.col("x").isNotNull() & finite)
    label = F.col("label") if relabel is None else relabel
    q = F.transform("x", lambda v: F.floor(v * F.lit(scale)).cast("long"))
    return stash(chosen.select(F.monotonically_increasing_id().alias("rid"), "id", label.cast("long").alias("label"), q.alias("q")), "vectors")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows of a matrix, shorter ones filled up with zeros."""
    out, sizes = np.zeros((len(column), dims), np.int64), column.value_lengths().to_numpy()
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy()
    return out


FOUND = "anchor long, positive long, id long, rid long, score long"


def _search(spread: DataFrame, block: list, dims: int, width: int, keep: int, margin: tuple[int, int] | None) -> DataFrame:
    """Rows FOUND of one pass. ``block``: (rid, label, components, [(positive, its score)]) of each anchor."""
    shared = spread.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PACKED):
                batch = whole.slice(at, PACKED)
                rid, ids, label = (batch.column(i).to_numpy() for i in range(3))
                packed = Packed(_matrix(batch.column(3), dims), width)
                out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
                for anchor, own, components, positives in shared.value:
                    score = packed.scores(components)
                    if margin is None:
                        places = first_of(score, ids, np.flatnonzero((label == own) & (rid != anchor)), keep)
                        out.append((anchor, 0, places, score[places]))
                        continue
                    low, high = margin
                    other = label != own
                    for k, best in positives:
                        # Exact in any range: a score beyond best / high * low lies at or above the rounded-up bound.
                        places = first_of(score, ids, np.flatnonzero(other & (score <= best) & (score >= -(-low * best // high))), keep)
                        out.append((anchor, k, places, score[places]))
                out = [x for x in out if len(x[2])]
                if out:
                    sizes = [len(x[2]) for x in out]
                    places = np.concatenate([x[2] for x in out])
                    arrays = [np.repeat([x[0] for x in out], sizes), np.repeat([x[1] for x in out], sizes), ids[places], rid[places], np.concatenate([x[3] for x in out])]
                    yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], ["anchor", "positive", "id", "rid", "score"])

    return spread.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, keep: int) -> DataFrame:
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def mine(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 5,
    margin: tuple[int, int] = (80, 100),
    scale: float = 256.0,
    relabel: Column | None = None,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    block: int = ANCHORS,
) -> DataFrame:
    """Per anchor, positive and negative: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``every`` divides. Scores are inner products of components floor(``scale`` * x). An
    anchor's positives are the first ``positives`` other rows of its label by falling score, then by id; a positive's
    negatives the first ``negatives`` rows of other labels whose score lies between ``margin[0] / margin[1]`` of the
    positive's score and that score. ``relabel`` gives the label from the columns ``id`` and ``label``.

    Rows with a null label or vector, or with a null or non-finite component, take no part. Rows without id are no
    anchors and come last among equal scores. Repeated rows count as rows of their own, each of them an anchor if
    its id makes it one. Missing components of shorter vectors count as zero. Of equal scores the smaller id comes
    first. No rows, or no anchors, give no rows; other columns are ignored. Vectors whose scores might not fit
    in a long raise an error.
    """
    spark = rows.sparkSession
    table = whole_rows(rows, id_col, label_col, vector_col, scale, relabel)
    largest = F.max(F.array_max(F.transform("q", lambda v: F.abs(v))))
    n, dims, largest = table.agg(F.count("*"), F.max(F.size("q")), largest).first()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    anchors = table.filter(F.col("id") % every == 0).select("rid", "id", "label", "q")
    # Few bytes, much arithmetic: rows are dealt out by number, whatever the size of their files.
    spread = table.select("rid", F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "q").repartition(max(1, -(-n // PACKED)))
    width = field_width(int(largest or 0), int(dims or 0))
    out, begin = scratch_path(spark, "negatives"), None
    while True:
        # The next block of anchors in the order of the table; only this block is held.
        later = anchors if begin is None else anchors.filter(F.col("rid") > begin)
        held = later.orderBy("rid").limit(block).collect()
        if not held:
            break
        begin = held[-1].rid
        base = [(r.rid, r.label, list(r.q), []) for r in held]
        near = _ranked(_search(spread, base, dims, width, positives, None), positives).collect()
        told: dict[int, list] = {}
        for r in near:
            told.setdefault(r.anchor, []).append((r.rank, r.score))
        second = [(*a[:3], told[a[0]]) for a in base if a[0] in told]
        places = spark.createDataFrame([(r.anchor, r["rank"], r.id, r.score) for r in near], "anchor long, positive long, positive_id long, positive_score long")
        owners = spark.createDataFrame([(r.rid, r.id) for r in held], "anchor long, anchor_id long")
        found = _ranked(_search(spread, second, dims, width, negatives, margin), negatives)
        full = found.join(F.broadcast(places), ["anchor", "positive"]).join(F.broadcast(owners), "anchor")
        own = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
        full.select(
            "anchor_id", own("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), own("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(out)
        if len(held) < block:
            break
    if begin is None:
        return spark.createDataFrame([], kinds)
    return spark.read.schema(kinds).parquet(out).select(*names)
