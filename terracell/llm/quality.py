"""Quality rules on repetition: characters inside duplicated n-grams and lines, by rolling hashes in numpy.

Every word has a 64-bit hash; the hash of n words follows from that of n - 1 by one multiplication and addition, for
all positions of a block of documents at once. Sorting the hashes of a length finds the windows that occur
again in the same document, and a running sum of window starts and ends tells which words they cover.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terracell.llm.common import text_blocks

WINDOW = 3
BASE = np.uint64(0x9E3779B97F4A7C15)
CACHED = 300_000
SYMBOLS = b"#*$%&|<>"

# Which of two classes a byte counts for: 1 begins a character of a word, 2 is a symbol.
CLASS = np.zeros(256, np.uint8)
CLASS[[b for b in range(256) if b & 0xC0 != 0x80 and b not in b" \t\n\x0b\x0c\r"]] = 1
CLASS[list(SYMBOLS)] |= 2


@dataclass(frozen=True)
class Rules:
    """Shares of a text's word characters, in percent, above which a document goes; symbols per 100 words."""

    min_words: int = 50
    repeat_words: int = 50
    ngram_chars: dict[int, float] = field(default_factory=lambda: {5: 20, 7: 20, 10: 20})
    line_chars: float = 30
    symbols: float = 10


class Words:
    """Hash and number of characters of words, kept while a task runs."""

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.hashes, self.sizes = np.empty(0, np.uint64), np.empty(0, np.int64)

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.place) > CACHED:
            self.__init__()
        new = list(set(words).difference(self.place))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.hashes = np.append(self.hashes, np.array([xxhash.xxh64_intdigest(w) for w in new], np.uint64))
            self.sizes = np.append(self.sizes, np.array([len(w.decode("utf-8", "replace")) for w in new], np.int64))
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return self.hashes[at], self.sizes[at]


def duplicated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys that occur more than once; which of these places are not the key's first."""
    order = np.argsort(keys)
    ranked = keys[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    chosen = same[1:] | same[:-1]
    places, begins = order[chosen], np.flatnonzero(~same[:-1][chosen])
    if not len(places):
        return places, np.empty(0, bool)
    firsts = np.minimum.reduceat(places, begins)
    return places, places != np.repeat(firsts, np.diff(np.append(begins, len(places))))


def measure(texts: list[bytes], cache: Words, lengths: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The counts of each text; ``dup_chars_<n>`` are word characters inside windows of n words that stand earlier in the text too."""
    split = [t.split() for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    doc = np.repeat(np.arange(len(texts)), n_words)
    hashes, sizes = cache.look_up([w for words in split for w in words])

    ends = np.cumsum([len(t) for t in texts])
    flags = CLASS[np.frombuffer(b"".join(texts), np.uint8)]

    def per_text(x: np.ndarray) -> np.ndarray:
        return np.diff(np.append(0, np.append(0, np.cumsum(x, dtype=np.int64))[ends]))

    out = {"n_words": n_words, "word_chars": per_text(flags & 1), "n_symbols": per_text(flags >> 1)}

    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    out["dup_line_chars"] = np.array([_again(x) if n else 0 for x, n in zip(lines, out["n_dup_lines"])], np.int64)

    own = doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    rolling = hashes.copy()
    wanted = {WINDOW, *lengths}
    for n in range(2, max(wanted) + 1):
        if len(doc) < n:
            rolling = rolling[:0]
        else:
            rolling = rolling[:-1] * BASE + hashes[n - 1 :]
        if n not in wanted:
            continue
        at = np.flatnonzero(doc[: len(rolling)] == doc[n - 1 :]) if len(rolling) else np.empty(0, np.int64)
        again, later = duplicated(rolling[at] + own[at])
        if n == WINDOW:
            covered = _covered(at[again], n, len(doc))
            out["n_repeat_words"] = np.bincount(doc[covered], minlength=len(texts))
        if n in lengths:
            covered = _covered(at[again[later]], n, len(doc))
            out[f"dup_chars_{n}"] = np.bincount(doc[covered], sizes[covered], len(texts)).astype(np.int64)
    return out


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    """Places that windows of ``n`` beginning ``at`` cover."""
    edge = np.bincount(at, minlength=size + 1) - np.bincount(at + n, minlength=size + 1)
    return np.cumsum(edge[:size]) > 0


def _again(lines: list[bytes]) -> int:
    """Word characters of lines equal to an earlier one."""
    seen: set[bytes] = set()
    total = 0
    for x in lines:
        if x in seen:
            total += sum(len(w.decode("utf-8", "replace")) for w in x.split())
        seen.add(x)
    return total


def verdict(m: dict[str, np.ndarray], rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of each text."""
    failed = (m["n_words"] < rules.min_words) | (100 * m["n_repeat_words"] > rules.repeat_words * m["n_words"])
    kept = ~failed & (100 * m["n_symbols"] <= rules.symbols * m["n_words"]) & (100 * m["dup_line_chars"] <= rules.line_chars * m["word_chars"])
    for n, most in rules.ngram_chars.items():
        kept &= 100 * m[f"dup_chars_{n}"] <= most * m["word_chars"]
    return failed, kept


def quality_report(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    dup_line_chars and dup_chars_<n> for each length of the rules.

    A null or empty text has no words: all counts 0, base_failed. A null id stays null, repeated rows each give a row,
    no rows give no rows, other columns are ignored. Whole texts are measured, a long one by itself. Window
    equality is that of 64-bit hashes inside one document.
    """
    lengths = tuple(sorted(rules.ngram_chars))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    more = ["dup_line_chars", *(f"dup_chars_{n}" for n in lengths)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        for batch, texts in text_blocks(batches):
            m = measure(texts, cache, lengths)
            failed, kept = verdict(m, rules)
            arrays = [batch.column(0), *(pa.array(m[c], pa.int64()) for c in counts), pa.array(failed), pa.array(kept), *(pa.array(m[c], pa.int64()) for c in more)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *counts, "base_failed", "kept", *more])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in counts), "base_failed boolean", "kept boolean", *(f"{c} long" for c in more)])
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, schema)


def keep_quality(docs: DataFrame, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns. Nothing is shuffled."""
    at = docs.columns.index(text_col)
    lengths = tuple(sorted(rules.ngram_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = Words()
        for batch, texts in text_blocks(batches, at):
            yield batch.filter(pa.array(verdict(measure(texts, cache, lengths), rules)[1]))

    return docs.mapInArrow(run, StructType(docs.schema.fields))
