"""Token counts by a two-tier lookup on the map side.

First pass: every task counts the pre-tokens of its documents and hands on only its most frequent ones, so that
all documents have a say and no pre-token is shuffled. The most frequent of all get their lengths from the
library and are broadcast as a compact table (at most ``table`` entries of at most 64 characters). Second pass: each
document's pre-tokens are looked up there, then in the worker's own cache, and misses are encoded in batches by
the library. Only speed depends on the table, never a count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import text_blocks
from terracell.llm.pretokens import LONGEST, LengthCache, word_pieces


def frequent_pieces(docs: DataFrame, text_col: str = "text", per_task: int = 4096, table: int = 32_768) -> list[str]:
    """The most frequent pre-tokens over all documents, as the tasks' own leaders tell."""
    room = 50 * per_task

    def leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for _, texts in text_blocks(batches, 0):
            for text in texts:
                seen.update(word_pieces(text.decode("utf-8", "replace")) or ())
            if len(seen) > room:
                seen = Counter(dict(seen.most_common(room // 4)))
        top = [(p, n) for p, n in seen.most_common(per_task) if len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    rows = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .mapInArrow(leaders, "piece string, n long")
        .groupBy("piece").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece").limit(table).select("piece").collect()
    )
    return [r.piece for r in rows]


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text", table: int = 32_768
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null. Repeated rows each give a row. No rows give
    no rows. Other columns are ignored. Texts of any length are counted whole.
    """
    pieces = frequent_pieces(docs, text_col, table=table)
    lengths = LengthCache(tokenizer_path, {}).count(pieces) if pieces else []
    shared = docs.sparkSession.sparkContext.broadcast(("\n".join(pieces), lengths))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined, sizes = shared.value
        cache = LengthCache(tokenizer_path, dict(zip(joined.split("\n"), sizes)) if sizes else {})
        for batch, texts in text_blocks(batches):
            counts = cache.count([t.decode("utf-8", "replace") for t in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
