"""Removal of repeated passages by sliding runs of sentences.

A text is cut after every run of ``. ! ?`` and line ends; the pieces, put together again, are the text. A run is several
consecutive sentences of at least ``words`` words together: from every sentence the shortest such run
forward, and to every sentence the shortest one backward, so that any repeated passage of that size is covered to both its
ends wherever it begins. A sentence of ``lone`` words or more is a run by itself. Runs are compared in lower case
and with white space as one blank, by 128 bits of hash. All runs are joined globally; sentences
in any run but the first of its kind go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracell.llm.common import text_blocks
from terracell.llm.repeats import OCCURRENCE, U64, covered, keyed, occurrences, own_id, settle, stretches, unpacked, with_verdicts

SENTENCE = re.compile(r"[^.!?\n]+[.!?\n]*|[.!?\n]+")


def sentences(text: str) -> list[str]:
    return SENTENCE.findall(text)


def sentence_runs(texts: list[bytes], several: int, words: int, lone: int) -> tuple[np.ndarray, ...]:
    """(text, first sentence, sentences - 1, two hashes) of the runs of all texts."""
    text_of, firsts, lasts, hashes = [], [], [], []
    for k, raw in enumerate(texts):
        clean = [" ".join(s.lower().split()).encode() for s in sentences(raw.decode("utf-8", "replace"))]
        counts = np.array([s.count(b" ") + 1 if s else 0 for s in clean], np.int64)
        real = np.flatnonzero(counts)
        if not len(real):
            continue
        # Pieces without words take no part; runs count the others.
        upto = np.append(0, np.cumsum(counts[real]))
        at = np.arange(len(real))
        end = np.maximum(np.searchsorted(upto, upto[:-1] + words) - 1, at + several - 1)
        begin = np.minimum(np.searchsorted(upto, upto[1:] - words, "right") - 1, at - several + 1)
        long = counts[real] >= lone
        pairs = np.concatenate([
            np.stack([at, end], 1)[end < len(real)],
            np.stack([begin, at], 1)[begin >= 0],
            np.stack([at, at], 1)[long],
        ])
        pairs = np.unique(pairs, axis=0)
        kept = [clean[i] for i in real]
        for a, b in pairs.tolist():
            hashes.append(xxhash.xxh3_128_digest(b" ".join(kept[a : b + 1])))
        text_of.append(np.full(len(pairs), k))
        firsts.append(real[pairs[:, 0]])
        lasts.append(real[pairs[:, 1]])
    if not hashes:
        return tuple(np.empty(0, k) for k in (np.int64, np.int64, np.int64, U64, U64))
    both = np.frombuffer(b"".join(hashes), np.uint64).reshape(-1, 2)
    first, last = np.concatenate(firsts), np.concatenate(lasts)
    return np.concatenate(text_of), first, last - first, both[:, 0].copy(), both[:, 1].copy()


def drop_repeated_spans(
    docs: DataFrame, several: int = 2, words: int = 25, lone: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_sentences, n_removed, n_spans (maximal removed runs of sentences), text (what is left).

    First is the run of the smallest id, then of the earliest sentence; a null id comes last, rows of one id
    are one document, whose equal places do not remove each other. A null text is empty: no sentences. A piece
    without words goes with the sentence before it if that goes. No rows give no rows, other columns are ignored.
    """
    texts = keyed(docs, id_col, text_col)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in text_blocks(batches, 2):
            text, first, more, name, span = sentence_runs(block, several, words, lone)
            yield occurrences(name, span, batch.column(0).to_numpy()[text], batch.column(1).to_numpy()[text], first, more)

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        names = ["doc_id", "n_sentences", "n_removed", "n_spans", "text"]
        rows, held = [], 0
        for doc, _, raw, first, more in unpacked(batches):
            pieces = sentences(raw.decode("utf-8", "replace"))
            gone = np.zeros(len(pieces), bool)
            if len(first):
                gone = covered(first, more, 1, len(pieces))
                for i, piece in enumerate(pieces):
                    if i and gone[i - 1] and not piece.strip():
                        gone[i] = True
            left = "".join(p for p, g in zip(pieces, gone) if not g)
            rows.append((own_id(doc), len(pieces), int(gone.sum()), len(stretches(gone)[0]), left))
            held += len(left)
            if len(rows) == 2000 or held > 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    late = settle(texts.mapInArrow(find, OCCURRENCE)).filter(~F.col("open")).drop("open")
    return with_verdicts(texts, late).mapInArrow(drop, "doc_id long, n_sentences long, n_removed long, n_spans long, text string")
