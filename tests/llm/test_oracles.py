"""Queries that SQL can express, against that SQL."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline  # noqa: F401  (registers the pipeline)
from terracell.llm import queries

from .conftest import SF


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    cur = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, cur.fetchall()))


def test_every_operator_has_one_query():
    names = sorted(queries.QUERIES)
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
