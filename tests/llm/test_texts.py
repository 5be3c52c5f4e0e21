"""Operators that look at one text at a time, against the libraries and plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from terracell.llm import decontaminate, quality, token_counts, token_files
from terracell.llm.common import scratch_path

from .plain import brute_distance

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def library(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def strange_texts():
    rng = random.Random(3)
    signs = ["'s", "'", "it's", " ", "  ", "\n", "\t", "é", "É", "ß", "ª", "²", "½", "12", "3", "!", "—", "你", "́", " ", "ẞ", "İ", "Σ", "<|endoftext|>", "abc", "<|", "\x0b"]
    return ["".join(rng.choices(signs, k=rng.randint(1, 25))) for _ in range(400)] + ["x" * 3000, "ab " * 3000, "é" * 70 + " é" * 70]


def counts_of(rows):
    return sorted((r.doc_id if r.doc_id is not None else -99, r.n_bytes, r.n_tokens, r.over_limit) for r in rows)


def test_token_counts_as_the_library_gives_them(spark, corpus):
    texts = strange_texts() + [t for _, t, _ in corpus]
    want = sorted((i, len(t.encode()), len(ids), len(ids) > 2048) for i, (t, ids) in enumerate(zip(texts, library(WORDS, texts))))
    assert counts_of(token_counts.token_counts(frame(spark, texts), WORDS, table=100).collect()) == want


def test_token_counts_of_odd_rows(odd, nothing):
    rows = odd.collect()
    ids = library(WORDS, [r.text or "" for r in rows])
    want = sorted((r.doc_id if r.doc_id is not None else -99, len((r.text or "").encode()), len(x), len(x) > 2048) for r, x in zip(rows, ids))
    assert counts_of(token_counts.token_counts(odd, WORDS).collect()) == want
    assert token_counts.token_counts(nothing, WORDS).count() == 0


def files_of(df, **args):
    out = scratch_path(df.sparkSession, "files")
    return token_files.write_token_files(df, out, BYTES, **args)


def test_token_files_round_trip(spark, corpus):
    texts = strange_texts() + [t for _, t, _ in corpus]
    manifest = files_of(frame(spark, texts), length=64)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, manifest).collect()}
    start, want, run = 0, {}, []
    for i, ids in enumerate(library(BYTES, texts)):
        ids = [*ids, 0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        run += ids
    assert got == want
    # Sequences are read by their number, as views of the mapped file, and masks tell what is real.
    at = 0
    for r in sorted(manifest.collect(), key=lambda r: r.part):
        real = 0
        for i in {0, r.n_sequences // 2, r.n_sequences - 1}:
            ids, mask = token_files.sequence(f"{r.path}.arrow", i)
            assert not ids.flags.owndata and len(ids) == len(mask) == 64
            kept = ids[np.array(mask.to_pylist())]
            assert kept.tolist() == run[at + 64 * i : at + min(64 * (i + 1), r.n_tokens)]
            real = max(real, i * 64 + len(kept))
        assert real == r.n_tokens
        with pytest.raises(IndexError):
            token_files.sequence(f"{r.path}.arrow", r.n_sequences)
        at += r.n_tokens


def test_scratch_folders_of_hadoop_names():
    assert token_files.known_uri("s3a://bucket/a/b") == "s3://bucket/a/b" == token_files.known_uri("s3n://bucket/a/b")
    assert [token_files.known_uri(u) for u in ("file:///a", "/a", "hdfs://n:8020/a", "s3://b/a")] == ["file:///a", "/a", "hdfs://n:8020/a", "s3://b/a"]


def test_token_files_of_odd_rows(spark, odd, nothing):
    got = token_files.read_token_files(spark, files_of(odd)).orderBy("start").collect()
    rows = odd.collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(ids) + 1 for ids in library(BYTES, [r.text or "" for r in rows]))
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d or 0))
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got, got[1:]))
    assert token_files.read_token_files(spark, files_of(nothing)).count() == 0


def plain_quality(text, lengths):
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]

    def inside(n, later_only):
        seen = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
        met, covered = set(), set()
        for i in range(len(w) - n + 1):
            gram = tuple(w[i : i + n])
            if seen[gram] > 1 and (gram in met or not later_only):
                covered |= set(range(i, i + n))
            met.add(gram)
        return covered

    repeat = len(inside(3, False))
    again, met = 0, set()
    for x in lines:
        again += sum(map(len, WORD.findall(x))) if x in met else 0
        met.add(x)
    counts = [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), repeat, again]
    return counts, [sum(len(w[i]) for i in inside(n, True)) for n in lengths], len(w) < 50 or 100 * repeat > 50 * len(w)


def check_quality(df):
    rules = quality.Rules()
    lengths = sorted(rules.ngram_chars)
    texts = Counter()
    for r in df.collect():
        counts, chars, failed = plain_quality(r.text or "", lengths)
        kept = not failed and 100 * counts[2] <= rules.symbols * counts[0] and 100 * counts[5] <= rules.line_chars * counts[1]
        kept = kept and all(100 * c <= rules.ngram_chars[n] * counts[1] for n, c in zip(lengths, chars))
        texts[r.doc_id, *counts, *chars, failed, kept] += 1
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_chars_{n}" for n in lengths), "base_failed", "kept"]
    report = quality.quality_report(df)
    assert Counter(tuple(r[n] for n in names) for r in report.collect()) == texts
    return report


def test_quality_counts(spark, corpus):
    rng = random.Random(5)
    few = [" ".join(rng.choices(["a", "bb", "é", "|", "c\n", "\n", "a b"], k=rng.randint(0, 200))) for _ in range(60)]
    check_quality(frame(spark, few + [t for _, t, _ in corpus]))


def test_quality_of_odd_rows(odd, nothing):
    report = check_quality(odd.select("doc_id", "text"))
    assert quality.quality_report(odd).count() == odd.count() and quality.quality_report(nothing).count() == 0
    kept = quality.keep_quality(odd)
    assert kept.columns == odd.columns and kept.count() == report.filter("kept").count()
    assert quality.keep_quality(nothing).count() == 0


def test_myers_against_plain_distance():
    rng = random.Random(7)
    for _ in range(500):
        item, text = ("".join(rng.choices("abc", k=rng.randint(a, b))) for a, b in ((1, 90), (0, 120)))
        masks = {c: sum(1 << i for i, x in enumerate(item) if x == c) for c in set(item)}
        most = rng.randint(0, len(item))
        got = decontaminate.myers(masks, len(item), text, most)
        least, end = brute_distance(item, text)
        assert got == ((least, end) if least <= most and end else None)


def test_leaks_against_plain_distance(spark):
    rng = random.Random(8)
    items = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(rng.randint(2, 40)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, items[0][1]), (53, "Filler"), (54, "zz end"), (55, "nothing of it"), (56, "fill")]
    docs = []
    for d in range(60):
        item = list(rng.choice(items[:12])[1])
        for _ in range(rng.randint(0, 8)):
            item[rng.randrange(len(item))] = rng.choice(["", "x", "zz", " "])
        text = " filler ".join(["".join(rng.choices("abc ", k=rng.randint(0, 60))), "".join(item), "end"])
        docs.append((d, text.upper() if d % 3 == 0 else text))
    docs += [(100, None), (None, items[3][1]), (101, items[3][1]), (101, items[3][1])]
    want, clean = Counter(), 0
    for d, text in docs:
        hits = []
        for i, item in items:
            item = decontaminate.normal(item or "")
            if item and len(item.split()) < 5 and text is not None and f" {item} " in f" {decontaminate.normal(text)} ":
                hits.append((d, i, 0))
            if len(item.split()) >= 5 and text is not None:
                least, _ = brute_distance(item, decontaminate.normal(text))
                if least <= int(len(item) * 0.05):
                    hits.append((d, i, least))
        want.update(hits)
        clean += not hits
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.leaks(docs, benchmark)
    assert Counter((r.doc_id, r.item_id, r.distance) for r in found.collect()) == want
    assert decontaminate.drop_leaks(docs, benchmark).count() == clean
    # The caller may spare documents from items that are no more than common words.
    long = {(d, i, n) for d, i, n in want if i not in (53, 54, 55, 56)}
    assert {(r.doc_id, r.item_id, r.distance) for r in decontaminate.leaks(docs, benchmark, min_words=3).collect()} <= long


def test_leaks_of_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    for a, b in ((odd, benchmark), (nothing, benchmark), (odd, benchmark.filter("item_id = 2"))):
        assert decontaminate.leaks(a, b).count() == 0
        left = decontaminate.drop_leaks(a, b)
        assert left.columns == a.columns and left.count() == a.count()


def test_items_in_several_blocks(spark):
    items = spark.createDataFrame([(i, f"item number {i} has its own words") for i in range(9)], "item_id long, text string")
    blocks = list(decontaminate.item_blocks(items, most_bytes=64))
    assert len(blocks) > 2 and sum(len(b.value) for b in blocks) == 9
