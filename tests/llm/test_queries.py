"""The registered queries over whole small tables."""

import math

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from postflow.llm.queries import ORACLE_SQL, QUERIES


def test_registration():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    found = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in found.description]
    wanted = sorted(repr(r) for r in found.fetchall())
    got = QUERIES[name](spark, sf_dir).select(*columns).collect()
    assert sorted(repr(tuple(r)) for r in got) == wanted and wanted


def test_nearest_neighbours_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    found: dict = {}
    for r in QUERIES["op1_prefix_forest"](spark, sf_dir).collect():
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        order = [j for j in np.lexsort((ids, -score)) if j != i][:20]
        hits += len({int(ids[j]) for j in order} & set(found[int(ids[i])]))
        total += 20
        for v, s in found[int(ids[i])].items():
            assert math.isclose(s, score[np.flatnonzero(ids == v)[0]], abs_tol=1e-12)
    assert hits / total >= 0.9


def test_quality_on_held_out_rows(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [r for r in QUERIES["op4_quality"](spark, "/root/testdata/sf0.01").collect()
            if r.held_out and labels.get(r.doc_id) is not None]
    assert len(rows) > 50 and np.mean([r.predicted == labels[r.doc_id] for r in rows]) >= 0.97
