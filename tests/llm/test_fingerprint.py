import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_cases import ODD, prose
from postflow.llm.fingerprint import (
    as_text, compared_with_next, fingerprints, hashes_of, in_descending_order, likeness, likeness_of, merged, sketches)


def shingles(text, k):
    w = "".join(c.lower() if c.isascii() else c for c in text).split(" ")
    w = [x for part in w for x in part.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def draw(text, **how):
    return sketches(pa.array([text], pa.string()), **how)[0]


def neighbours(rows):
    """Rows in descending order of the key, each with the next text; equal keys must have equal texts."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(i, t or "", rows[(n + 1) % len(rows)][1] or "") for n, (i, t) in enumerate(rows)]


@pytest.mark.parametrize("range_bytes", [1 << 30, 3000])
def test_edited_texts_in_order(spark, documents, range_bytes):
    rows = [(i * 7 % 41, t) for i, t in enumerate(ODD + [prose(n, n) for n in (1, 3, 6, 50, 900)])]
    rows += [(-3, "last of all"), (500, "twice the same row"), (500, "twice the same row"), (None, "no key"), (2**62, None)]
    want = []
    for i, t, after in neighbours(rows):
        third = len(t) // 3
        edited = t[:len(t) - third] + after[:third]
        s, e, a = draw(t), draw(edited), draw(after)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), as_text(s), as_text(e), likeness(s, e), likeness(s, a)))
    got = [tuple(r) for r in compared_with_next(documents(rows), range_bytes=range_bytes).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_ranges_are_many_and_even(spark, documents):
    dealt = in_descending_order(documents([(i, prose(20, i)) for i in range(400)], 5), range_bytes=4000)
    sizes = [r["count"] for r in dealt.filter("peek = 0").groupBy("part").count().collect()]
    assert len(sizes) > 5 and max(sizes) < 8 * min(sizes)
    assert dealt.filter("peek = 1").count() == len(sizes)


def test_equal_keys_of_different_texts_are_in_several_ranges(spark, documents):
    rows = [(5, prose(30, i)) for i in range(200)] + [(9, "a"), (1, "z")]
    dealt = in_descending_order(documents(rows, 4), range_bytes=4000)
    assert dealt.filter("doc_id = 5").select("part").distinct().count() > 3
    got = compared_with_next(documents(rows, 4), range_bytes=4000).collect()
    assert sorted((r.doc_id, r.n_chars) for r in got) == sorted((i, len(t)) for i, t in rows)


def test_one_row_and_no_row(spark, documents):
    only = compared_with_next(documents([(4, "one two three four five six")])).collect()
    assert len(only) == 1 and only[0].near_next == 1.0
    assert compared_with_next(documents([])).collect() == []
    assert [r.fingerprint for r in fingerprints(documents([(1, None), (2, " \n")])).collect()] == ["", ""]


def test_estimates_of_containment():
    long, short = prose(6000, 1), prose(6000, 1)[2000:9000]
    a, b = shingles(long, 5), shingles(short, 5)
    true = len(a & b) / min(len(a), len(b))
    assert abs(likeness(draw(long), draw(short)) - true) < 0.1
    assert abs(len(draw(long)) - len(a) / 8) < 4 * np.sqrt(len(a) / 8)
    assert likeness(draw(prose(500, 2)), draw(prose(500, 2))) == 1.0 and likeness(draw(""), draw("")) == 1.0
    assert likeness(draw(""), draw("a b c d e f")) == 0.0
    assert len(draw(long, fraction=1.0)) == len(a)


def test_merging_is_the_sketch_of_all_texts(spark, documents):
    texts = [prose(n, n) for n in (2, 7, 60, 300)]
    whole = set().union(*[draw(t, fraction=1.0).tolist() for t in texts])
    limit = 2**64 // 8
    want = {f"{h:016x}" for h in whole if h < limit}
    drawn = fingerprints(documents(list(enumerate(texts)))).selectExpr("1 AS g", "fingerprint")
    assert {r.hash for r in merged(drawn, ["g"]).collect()} == want and want
    single = fingerprints(documents([(0, "tiny text"), (1, "tiny text")])).selectExpr("doc_id AS g", "fingerprint")
    assert len(merged(single, ["g"]).collect()) == 2


def test_column_forms(spark, documents):
    texts = [prose(200, 1), prose(200, 1)[:700], "a b", ""]
    df = fingerprints(documents(list(enumerate(texts))))
    pairs = df.alias("x").join(df.alias("y"), on=None, how="inner").selectExpr(
        "x.doc_id AS i", "y.doc_id AS j", "x.fingerprint AS a", "y.fingerprint AS b")
    for r in pairs.withColumn("s", likeness_of(F.col("a"), F.col("b"))).withColumn("n", F.size(hashes_of(F.col("a")))).collect():
        assert r.s == likeness(draw(texts[r.i]), draw(texts[r.j])) and r.n == len(draw(texts[r.i]))
