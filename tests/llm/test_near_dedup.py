import random
import re

import numpy as np
import pytest

from llm_cases import ODD, prose
from postflow.llm.components import components
from postflow.llm.near_dedup import drop_near_duplicates, forest_links, least_matches, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def brute(rows, k, percent):
    """Component of each row position, and set sizes."""
    sets = [shingle_set(t, k) for _, t in rows]
    comp = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((comp[a], comp[b]))
                comp = [low if c == high else c for c in comp]
    return comp, [len(s) for s in sets]


def family(seed, size, words, changes):
    rng = random.Random(seed)
    base = prose(words, seed).split()
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(changes)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def rows():
    texts = list(ODD) + family(1, 60, 120, 6) + family(2, 20, 30, 3) + ["Same  text here ", "same text\there"] * 3
    out = list(enumerate(texts, 100))
    return out + [(100, "repeated row of some words")] * 2 + [(None, "repeated row of some words"), (7, None)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_against_brute_force(documents, k, percent):
    cases = rows()
    comp, sizes = brute(cases, k, percent)
    wanted = []
    for i, (key, _) in enumerate(cases):
        keys = [cases[j][0] for j in range(len(cases)) if comp[j] == comp[i] and cases[j][0] is not None]
        least = key if not sizes[i] else min(keys, default=None)
        wanted.append((repr(key), sizes[i], repr(least), key == least))
    got = near_duplicates(documents(cases), k=k, percent=percent).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in got) == sorted(wanted)


def test_one_row_of_each_component_stays(documents):
    cases = rows()
    comp, sizes = brute(cases, 5, 80)
    df = documents(cases)
    got = drop_near_duplicates(df)
    assert got.schema == df.schema
    kept = [r.doc_id for r in got.collect()]
    groups: dict = {}
    for i, (key, _) in enumerate(cases):
        groups.setdefault(comp[i] if sizes[i] else ("empty", i), []).append(key)
    wanted = [min([k for k in g if k is not None], default=None) for g in groups.values()]
    assert sorted(map(repr, kept)) == sorted(map(repr, wanted))


def test_empty_table(documents):
    assert near_duplicates(documents([(1, "a")]).filter("doc_id = 0")).collect() == []


def test_parts_of_a_cluster_give_the_same_components():
    texts = family(5, 40, 80, 7)
    sets = [np.unique([hash(s) & (2**63 - 1) for s in shingle_set(t, 3)]).astype(np.uint64) for t in texts]
    tokens = np.zeros((len(texts), 8), np.int64)  # equal: all pairs are candidates
    one = forest_links(list(range(40)), np.zeros(40, int), tokens, sets, 1, 85)
    parts = np.arange(40) % 3
    split = []
    for a in range(3):
        for b in range(a, 3):
            pick = np.flatnonzero((parts == a) | (parts == b))
            split += forest_links(pick.tolist(), parts[pick], tokens[pick], [sets[i] for i in pick], 1, 85)

    def labels(links):
        comp = list(range(40))
        for a, b in links:
            low, high = sorted((comp[a], comp[b]))
            comp = [low if c == high else c for c in comp]
        return comp

    assert labels(one) == labels(split) and len(one) < 40


def test_least_matches():
    assert least_matches(32, 85) < 0.85 * 32 and least_matches(4, 100) == 4


def test_long_chain(spark):
    rng = random.Random(4)
    order = list(range(200))
    rng.shuffle(order)
    edges = [(order[i], order[i + 1]) for i in range(120)] + [(order[i], order[i + 1]) for i in range(121, 199)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "chain").collect()}
    first, second = order[:121], order[121:]
    assert got == {**{n: min(first) for n in first}, **{n: min(second) for n in second}}
