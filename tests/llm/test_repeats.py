"""Exact substrings and sentence spans, against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from terracell.llm import repeats, sentence_spans, suffixes

from .conftest import words


def order(doc):
    return doc is None, doc or 0


def plain_removal(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    first = {}
    for (doc, _), t in zip(rows, texts):
        for p in range(len(t) - length + 1):
            key = (*order(doc), p)
            first[t[p : p + length]] = min(first.get(t[p : p + length], key), key)
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if (*order(doc), p) > first[t[p : p + length]]:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        kept = bytes(c for c, x in zip(t, gone) if not x)
        out.append((*order(doc), len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removal(df, length=100):
    return sorted((*order(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.removal_report(df, length).collect())


def mixed_rows(seed):
    rng = random.Random(seed)
    pool = [words(rng, 60) for _ in range(6)]
    rows = []
    for d in range(50):
        parts = []
        for _ in range(rng.randint(0, 5)):
            kind, p = rng.random(), rng.choice(pool)
            at = rng.randint(0, len(p) // 2)
            if kind < 0.4:
                parts.append(p[at : at + rng.randint(60, 300)])
            elif kind < 0.5:
                parts.append(rng.choice(["a", "ab", "x yz "]) * rng.randint(10, 300))
            else:
                parts.append(words(rng, rng.randint(1, 50)))
        rows.append((rng.choice([d, d, d, d // 2, None if d % 20 == 0 else d]), "".join(parts)))
    near = words(rng, 300)
    for d in range(300, 320):
        text = list(near)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(len(text))] = "Z"
        rows.append((d, "".join(text)))
    rows += [(5, None), (7, ""), (200, rows[3][1]), (200, rows[3][1]), (201, rows[3][1] + "x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "length", "crowd"), [(1, 100, 2048), (2, 100, 2), (3, 130, 5)])
def test_removal_against_brute_force(spark, monkeypatch, seed, length, crowd):
    """With a small crowd, names that few runs share are settled by windows."""
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    monkeypatch.setattr(suffixes, "CHUNK", 64)
    rows = mixed_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removal(df, length) == plain_removal(rows, length)


def test_removal_of_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert removal(odd) == plain_removal(rows, 100)
    assert suffixes.removal_report(nothing).count() == 0
    with pytest.raises(ValueError, match="length"):
        suffixes.remove_repeats(odd, 50)


def test_spans_tell_what_was_removed(spark):
    text = words(random.Random(4), 100)
    df = spark.createDataFrame([(1, text), (2, "own start " + text[:300] + " own end")], "doc_id long, text string")
    r = suffixes.remove_repeats(df).filter("doc_id = 2").first()
    whole = ("own start " + text[:300] + " own end").encode()
    assert len(r.spans) == 1 and whole[: r.spans[0].begin] + whole[r.spans[0].end :] == bytes(r.kept)
    assert r.n_removed == r.spans[0].end - r.spans[0].begin == len(whole) - len(r.kept)


def test_runs_do_not_depend_on_their_surroundings(monkeypatch):
    rng = random.Random(9)
    shared = words(rng, 80).encode()
    one, other = (words(rng, 40).encode() + shared + words(rng, 40).encode() for _ in range(2))

    def inner():
        text, first, more, name, span = suffixes.runs([one, b"", b"short", other], 100)
        assert (first[text == 0][0], (first + more)[text == 0][-1]) == (0, len(one) - 100)
        assert (np.diff(first[text == 3]) == more[text == 3][:-1] + 1).all()
        return {k: set(zip(name[text == k].tolist(), span[text == k].tolist())) for k in (0, 3)}

    found = inner()
    assert len(found[0] & found[3]) > 3
    monkeypatch.setattr(suffixes, "STEP", 150)
    inner()


def plain_spans(rows, several, least, lone):
    split = [sentence_spans.sentences(t or "") for _, t in rows]
    clean = [[" ".join(s.lower().split()) for s in ss] for ss in split]
    runs = []
    for k, ss in enumerate(clean):
        real = [i for i, s in enumerate(ss) if s]
        size = [len(ss[i].split()) for i in real]
        pairs = {(a, a) for a in range(len(real)) if size[a] >= lone}
        for a in range(len(real)):
            fits = [b for b in range(a + several - 1, len(real)) if sum(size[a : b + 1]) >= least]
            pairs |= {(a, fits[0])} if fits else set()
            fits = [b for b in range(a - several + 1, -1, -1) if sum(size[b : a + 1]) >= least]
            pairs |= {(fits[0], a)} if fits else set()
        runs += [(" ".join(ss[real[i]] for i in range(a, b + 1)), (*order(rows[k][0]), real[a]), k, real[a], real[b]) for a, b in pairs]
    first = {}
    for content, place, *_ in runs:
        first[content] = min(first.get(content, place), place)
    gone = [set() for _ in rows]
    for content, place, k, a, b in runs:
        if place > first[content]:
            gone[k] |= set(range(a, b + 1))
    out = []
    for k, (doc, _) in enumerate(rows):
        for i in range(1, len(split[k])):
            if not split[k][i].strip() and i - 1 in gone[k]:
                gone[k].add(i)
        spans = sum(1 for i in gone[k] if i - 1 not in gone[k])
        out.append((*order(doc), len(split[k]), len(gone[k]), spans, "".join(s for i, s in enumerate(split[k]) if i not in gone[k])))
    return sorted(out)


def spans(df, *args):
    found = sentence_spans.drop_repeated_spans(df, *args).collect()
    return sorted((*order(r.doc_id), r.n_sentences, r.n_removed, r.n_spans, r.text) for r in found)


@pytest.mark.parametrize(("seed", "args"), [(1, (2, 4, 8)), (2, (3, 1, 100)), (3, (2, 25, 50))])
def test_sentence_spans_against_brute_force(spark, seed, args):
    rng = random.Random(seed)
    pool = [words(rng, rng.randint(1, 12)).capitalize() + rng.choice([".", "!", "?", ".\n", "..\n\n", "\n", ". \n "]) for _ in range(25)]
    rows = [(rng.choice([d, d, d // 2, None if d % 15 == 0 else d]), " ".join(rng.choices(pool, k=rng.randint(0, 25)))) for d in range(60)]
    rows += [(3, None), (70, rows[9][1].upper()), (71, rows[9][1]), (71, rows[9][1]), (72, words(rng, 60)), (73, "X. " + words(rng, 60))]
    rows += [(74, rows[-1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert spans(df, *args) == plain_spans(rows, *args)


def test_sentence_spans_of_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert spans(odd) == plain_spans(rows, 2, 25, 50)
    assert sentence_spans.drop_repeated_spans(nothing).count() == 0


def test_passages_of_the_corpus(spark, corpus):
    """A passage of over 50 words stays where it came first only; a clean text stays whole."""
    rng = random.Random(11)
    passage = " ".join(words(rng, n).capitalize() + "." for n in (9, 31, 4, 12))
    rows = [(i, "\n".join([words(rng, 40) + ".", passage, words(rng, 30) + "."])) for i in range(20)]
    rows += [(100 + i, ". ".join(words(rng, 8) for _ in range(6))) for i in range(20)]
    got = {r.doc_id: r for r in sentence_spans.drop_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        if 0 < i < 100:
            assert not any(s in got[i].text for s in passage.split(". ")) and got[i].n_removed == 4
        else:
            assert got[i].text == text and got[i].n_removed == 0


def test_settle_over_many_batches(spark):
    """Names whose rows span batches: later ones are told, first ones are open beside another span."""
    rng = random.Random(2)
    rows = [(n, s, d, 0, f, 0) for n in range(6) for s in range(n % 3 + 1) for d in range(40) for f in rng.sample(range(9), 2)]
    rows += [(50, 1, 1, 0, 0, 0), (60, 1, 1, 1, 5, 0), (60, 1, 1, 2, 5, 0)]
    df = spark.createDataFrame(rows, repeats.OCCURRENCE).repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = sorted((r.doc, r.twin, r.first, r.open) for r in repeats.settle(df).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    first, several = {}, {}
    for n, s, d, _, f, _ in rows:
        first[n, s] = min(first.get((n, s), (d, f)), (d, f))
        several.setdefault(n, set()).add(s)
    want = []
    for n, s, d, t, f, _ in rows:
        if (d, f) > first[n, s]:
            want.append((d, t, f, False))
        elif len(several[n]) > 1 or (n == 60 and t == 2):
            want.append((d, t, f, True))
    assert got == sorted(want)


def test_removal_on_the_corpus(spark, corpus):
    rows = [(d, t) for d, t, _ in corpus]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert removal(df) == plain_removal(rows, 100)


def test_repeated_rows_list_their_places_once(spark):
    """Rows of one id (or none) and one text share their verdicts, whose list does not grow with them."""
    text = words(random.Random(8), 80)
    df = spark.createDataFrame([(0, text)] + [(None, text)] * 60 + [(3, text + text)] * 40, "doc_id long, text string").repartition(7)
    texts = repeats.keyed(df, "doc_id", "text")
    places = texts.selectExpr("doc", "twin", "explode(sequence(0L, 4L)) AS first", "7 AS more")
    sizes = {len(r["first"]) for r in repeats.with_verdicts(texts, places).collect()}
    assert sizes == {5}
    assert removal(df) == plain_removal(df.collect(), 100)
