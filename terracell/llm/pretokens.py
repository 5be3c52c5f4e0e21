"""Pre-tokens whose encoding does not depend on their neighbours, cached per worker.

The library encodes a text pre-token by pre-token, so equal pre-tokens give equal ids everywhere. Pre-tokens
are split here only in texts of ASCII and Latin-1 characters, where the classes below are the whole truth.
Any other text, and any that may hold a special token's string, goes through the library as a whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
DIGIT = "0-9\xb2\xb3\xb9\xbc-\xbe"
# Latin-1 characters that a text split here may hold, as bytes.
PLAIN = bytes([*range(9, 14), *range(32, 127), *range(160, 256)])

# The splitting patterns of the two vocabularies, with the classes spelled out for Latin-1.
# The short forms begin with a sign of their own, so they may stand behind the letters, which are far more frequent.
BYTE_LEVEL = re.compile(f" ?[{LETTER}]+| ?[{DIGIT}]+|'(?:s|t|re|ve|m|ll|d)| ?[^\\s{LETTER}{DIGIT}]+|\\s+(?!\\S)|\\s+")
WORD_LEVEL = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^\\s{LETTER}{DIGIT}]+")

# Longer pre-tokens are encoded each time; more cached ones than this are dropped together.
LONGEST = 64
CACHED = 400_000
# Ids of pre-tokens that a worker holds in two generations, some 200 bytes each.
HELD = 1_500_000


def strange(text: str) -> bool:
    """Whether only the library may split the text."""
    try:
        return bool(text.encode("latin-1").translate(None, PLAIN)) or "<|" in text
    except UnicodeEncodeError:
        return True


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Tokenizer:
    found = Tokenizer.from_file(path)
    found.no_padding()
    found.no_truncation()
    return found


class IdCache:
    """Ids of texts under a byte-level vocabulary, as little-endian bytes of ``dtype``."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        size = self.library.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        # Ids that begin with the vocabulary's sign for a blank.
        self.begins = np.zeros(size, bool)
        self.begins[[i for t, i in self.library.get_vocab().items() if t[0] == "\u0120"]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > HELD // 2:
            self.known, self.older = {}, self.known
        known, older, findall = self.known, self.older, BYTE_LEVEL.findall
        split = [None if strange(t) else findall(t) for t in texts]
        missing = set().union(*filter(None, split)).difference(known)
        if older:
            again = missing.intersection(older)
            known.update((p, older[p]) for p in again)
            missing -= again
        fresh = self._pieces(missing)
        long = {k: fresh.pop(k) for k in [k for k in fresh if len(k) > LONGEST]}
        known.update(fresh)
        whole = iter(self._whole([t for t, pieces in zip(texts, split) if pieces is None]))
        get = (known | long if long else known).__getitem__
        return [next(whole) if pieces is None else b"".join(map(get, pieces)) for pieces in split]

    def _pieces(self, pieces: set[str], together: int = 1000) -> dict[str, bytes]:
        """Ids of single pre-tokens. Words behind a blank go to the library many in a row: it cuts them at
        the blanks, and only a word's first id begins with one."""
        words, others = [], []
        for p in pieces:
            (words if p[0] == " " and p[1:].isalpha() else others).append(p)
        out = dict(zip(others, self._whole(others)))
        for at in range(0, len(words), together):
            row = words[at : at + together]
            ids = np.frombuffer(self._whole(["".join(row)])[0], self.dtype)
            cuts = np.append(np.flatnonzero(self.begins[ids]), len(ids))
            if len(cuts) != len(row) + 1:
                out.update(zip(row, self._whole(row)))
                continue
            raw, cuts = ids.tobytes(), (cuts * self.dtype.itemsize).tolist()
            out.update(zip(row, map(raw.__getitem__, map(slice, cuts, cuts[1:]))))
        return out

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=1)
def id_cache(path: str) -> IdCache:
    """The worker's own cache, which tasks that run in it one after the other share."""
    return IdCache(path)


class LengthCache:
    """Token counts of texts under a vocabulary of lower-case words: a shared table first, then this worker's cache."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.library = tokenizer(path)
        self.frequent = frequent
        self.known = dict(frequent)

    def count(self, texts: list[str]) -> list[int]:
        split = [word_pieces(t) for t in texts]
        if len(self.known) > len(self.frequent) + CACHED:
            self.known = dict(self.frequent)
        known = self.known
        missing = list({p for pieces in split if pieces for p in pieces}.difference(known))
        fresh = dict(zip(missing, self._whole(missing)))
        known.update((k, v) for k, v in fresh.items() if len(k) <= LONGEST)
        long = {k: v for k, v in fresh.items() if len(k) > LONGEST}
        whole = iter(self._whole([t for t, pieces in zip(texts, split) if pieces is None]))
        if long:
            known = known | long
        return [next(whole) if pieces is None else sum(map(known.__getitem__, pieces)) for pieces in split]

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]


def word_pieces(text: str) -> list[str] | None:
    """Pre-tokens of the word vocabulary; None where only the library may split the text."""
    return None if strange(text) else WORD_LEVEL.findall(text.lower())
