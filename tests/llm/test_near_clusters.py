"""Clusters that single tokens chain together are cut up, and nothing that belongs together is."""

import numpy as np
import pytest

from llm_cases import prose
from postflow.llm import near_dedup
from postflow.llm import textarrays as ta
from test_near_dedup import family


@pytest.mark.parametrize("n,t", [(32, 17), (32, 15), (8, 4)])
def test_any_t_coordinates_hold_a_set(n, t):
    rng = np.random.default_rng(n + t)
    for r in range(2, t + 1):
        if n < 32 or r < 5:
            sets = near_dedup.token_sets(n, t, r)
            assert sets.shape[1] == r and all(len({*s}) == r for s in sets.tolist())
            for _ in range(200):
                equal = np.zeros(n, bool)
                equal[rng.permutation(n)[:t]] = True
                assert equal[sets].all(1).any()
    assert all(len(s) <= near_dedup.MOST_SETS for s in near_dedup._refining(n, t))


def test_a_chain_of_single_tokens_is_cut(spark):
    """300 classes in one cluster, each with one or two tokens of the one before; 20 of them alike in 17."""
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 2**32, (300, 32)) | (np.arange(32) << 32)
    for i in range(1, 300):
        tokens[i, i % 31:i % 31 + 1 + i % 2] = tokens[i - 1, i % 31:i % 31 + 1 + i % 2]
    for i in range(201, 220):
        tokens[i, rng.permutation(32)[:17]] = -1  # below: those of the first of the alike
    tokens = np.where(tokens < 0, tokens[200], tokens)
    classes = spark.createDataFrame([(i, 50, row.tolist()) for i, row in enumerate(tokens)],
                                    "rid long, n_shingles long, tokens array<long>")
    clusters = spark.createDataFrame([(i, 0) for i in range(300)], "rid long, cluster long")
    sized, parts = near_dedup.sized_clusters(clusters, classes, 32, 17, 1000)
    got = {r.rid: r.cluster for r in sized.collect()}
    alike = {i for i in range(200, 220)}
    assert alike <= set(got) and len({got[i] for i in alike}) == 1
    assert len(got) <= 30
    assert {r.cluster: r.parts for r in parts.collect()}.keys() == set(got.values())
    whole, _ = near_dedup.sized_clusters(clusters, classes, 32, 17, 300 * 50 * 8)  # one part: left alone
    assert {(r.rid, r.cluster) for r in whole.collect()} == {(i, 0) for i in range(300)}


def test_small_parts_give_the_same_components(documents):
    texts = family(1, 40, 120, 6) + family(2, 20, 90, 9) + [prose(80, i) for i in range(30)]
    df = documents(list(enumerate(texts)))

    def found(**options):
        return sorted((bytes(r.digest), r.component_id) for r in near_dedup.linked_rows(
            df, "doc_id", "text", 3, 85, ta.NONSPACE, **options)[1].collect())

    assert found(part_bytes=2000) == found()
