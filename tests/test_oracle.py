"""Every registered query against its DuckDB oracle (the driver's correctness gate, locally)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from postflow.plans.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("\x00<NULL>" if r[i] is None else str(r[i]) for i in order) for r in rows), \
        sorted(columns)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, duck, key):
    df = entry.queries()[key](spark, sf_dir)
    got, got_cols = _norm([tuple(r) for r in df.collect()], df.columns)
    res = duck.execute(entry.oracle_sql()[key])
    want, want_cols = _norm(res.fetchall(), [d[0] for d in res.description])
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["hashtag", "count"]
    assert rows and all(rows[i]["count"] >= rows[i + 1]["count"] for i in range(len(rows) - 1))
