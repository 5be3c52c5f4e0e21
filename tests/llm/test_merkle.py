"""Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terracell.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([sha("".join(row[i : i + 2])) for i in range(0, len(row), 2)])
    return levels


def steps(levels, i):
    for row in levels[:-1]:
        run = range(i - i % 2, min(i - i % 2 + 2, len(row)))
        yield [row[k] if k != i else None for k in run]
        i //= 2


def plain(rows):
    """Counter of result rows for (doc_id, lang, digest, version)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    trees = {g: tree([r[2] for r in groups[g]]) for g in names}
    top = tree([trees[g][-1][0] for g in names])
    out = Counter()
    for k, g in enumerate(names):
        for i, (doc, _, own, version) in enumerate(groups[g]):
            path = [*steps(trees[g], i), *steps(top, k)]
            proof = sha("".join(x for run in path for x in run if x))
            folded = version or own
            for run in path:
                folded = sha("".join(x or folded for x in run))
            root = top[-1][0]
            out[doc, own, trees[g][-1][0], root, proof, folded, folded == root] += 1
    return out


def got(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("height", [1, 2, 10])
def test_against_a_plain_tree(spark, height):
    """Groups of one to many blocks, a lone leaf, full and ragged blocks, more groups than a block holds."""
    rows = []
    for g, n in enumerate([1, 2, 3, 4, 5, 8, 9, 16, 17, 33, 64, 65]):
        for i in range(n):
            own = sha(f"{g} {i}")
            rows.append((i * 7 - 20, None if g == 3 else f"g{g:02d}", own, sha(own) if i % 3 == 0 else None))
    df = spark.createDataFrame(rows, "doc_id long, lang string, own string, changed string").repartition(5)
    found = merkle.manifest(df, F.col("own"), F.col("changed"), F.col("lang"), height=height)
    assert got(found) == plain(rows)


def test_one_leaf_is_the_root(spark):
    df = spark.createDataFrame([(5, "en", sha("x"))], "doc_id long, lang string, own string")
    (row,) = merkle.manifest(df, F.col("own"), F.lit(None).cast("string"), F.col("lang")).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root == sha("x") and row.proof_sha256 == sha("") and row.verified


def test_hot_group_over_many_ranges(spark):
    """A group that fills most ranges, with groups that begin and end in others."""
    rows = [(i, "b", sha(str(i)), None) for i in range(3000)] + [(i, f"a{i}", sha(f"a{i}"), None) for i in range(50)] + [(i, None, sha(f"n{i}"), None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, own string, changed string").repartition(7)
    assert got(merkle.manifest(df, F.col("own"), F.col("changed"), F.col("lang"), height=3)) == plain(rows)


def test_documents_with_odd_rows(odd, nothing):
    """Nulls in every field, repeated rows and ids, long texts; a null count stays as it is."""
    rows = odd.selectExpr("*", "IF(doc_id = 4, 9223372036854775807, length(text)) AS n_chars", "IF(doc_id = 7, NULL, 'en') AS lang")
    want = []
    for r in rows.collect():
        values = [r.doc_id, r.source, r.lang, r.n_chars, r.text]
        tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and r.n_chars is not None
        more = [*values[:3], r.n_chars + 1, r.text] if tampered else None
        want.append((r.doc_id, r.lang, leaf(*values), more and leaf(*more)))
    found = got(merkle.document_manifest(rows, 2))
    assert found == plain(want) and {k[-1] for k in found} == {True, False}
    none = nothing.selectExpr("*", "1L AS n_chars", "'en' AS lang")
    assert merkle.document_manifest(none).count() == 0


def test_manifest_does_not_depend_on_partitions(spark, corpus):
    df = spark.createDataFrame([(d, t, s, s, len(t or "")) for d, t, s in corpus], "doc_id long, text string, lang string, source string, n_chars long")
    assert got(merkle.document_manifest(df.repartition(1))) == got(merkle.document_manifest(df.repartition(6)))
