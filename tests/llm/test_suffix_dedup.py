import hashlib
import random

import pytest

from llm_cases import ODD, prose
from postflow.llm.suffix_dedup import (kept_bytes, measure_repeats, merge_runs, pack_run, remove_repeats,
                                       unpack_run)


def brute(texts, length):
    """Removed bytes of each text."""
    data = [(t or "").encode() for t in texts]
    seen: dict = {}
    for d, x in enumerate(data):
        for i in range(len(x) - length + 1):
            seen.setdefault(x[i:i + length], []).append((d, i))
    gone = [[False] * len(x) for x in data]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i:i + length] = [True] * length
    return data, gone


def rows(seed, n, alphabet, size):
    rng = random.Random(seed)
    stock = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(size))) for _ in range(12)]
    return ["".join(rng.choice(stock) if rng.random() < 0.6 else rng.choice(alphabet)
                    for _ in range(rng.randrange(8))) for _ in range(n)]


def check(df, keyed, length, **options):
    data, gone = brute([t for _, t in keyed], length)
    wanted = []
    for (key, _), x, g in zip(keyed, data, gone):
        spans = sum(a and not b for a, b in zip(g, [False] + g))
        kept = bytes(c for c, a in zip(x, g) if not a)
        wanted.append((repr(key), len(x), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    got = measure_repeats(df, length=length, **options).collect()
    assert sorted((repr(r.doc_id), *r[1:]) for r in got) == sorted(wanted)
    assert any(w[2] for w in wanted)


@pytest.mark.parametrize("alphabet,most,heavy", [("ab", 10**9, 10**9), ("ab", 0, 10**9), ("ab", 10**9, 3),
                                                  ("abcdefgé", 0, 10**9), ("abcdefgé", 10**9, 10**9),
                                                  ("a", 10**9, 10**9), ("a", 0, 3)])
def test_random_texts_against_brute_force(documents, alphabet, most, heavy):
    keyed = list(enumerate(rows(len(alphabet), 60, alphabet, 40)))
    check(documents(keyed), keyed, 24, gram=6, most_pairs=most, heavy=heavy, bucket_suffixes=50)


def test_strings_of_a_suffix_dealt_twice_count_once(documents):
    keyed = list(enumerate(rows(2, 60, "ab", 40)))
    check(documents(keyed), keyed, 24, gram=6, most_pairs=0, heavy=3, bucket_suffixes=10**6)


def test_no_task_gathers_a_passage_of_a_third_of_the_rows(documents):
    from postflow.llm import suffix_dedup as sd
    rng = random.Random(9)

    def own(n):
        return "".join(rng.choice("abcdefghij") for _ in range(n))

    passage = own(90)
    keyed = [(i, own(rng.randrange(30, 60)) + (passage if i % 3 == 0 else own(90)) + own(rng.randrange(30, 60)))
             for i in range(240)]
    df = documents(keyed)
    check(df, keyed, 40, gram=8, heavy=20, bucket_suffixes=30)
    runs, strings = sd._dealt(sd._numbered(df.select("doc_id", "text")), 1, 40, 8, 20, 30)
    groups: dict = {}
    for row in runs.collect():
        for _, right, left, _, _, weight in (unpack_run(row.run) if row.kind == 1 else ()):
            half = {0: right[:8], 1: right[:20], 2: left[-20:]}[weight >> 2]
            groups[weight >> 2, half] = groups.get((weight >> 2, half), 0) + 1
    assert max(groups.values()) <= 30 and strings.count() > 0


def test_default_length_and_odd_texts(documents):
    passage = prose(90, 5)
    keyed = list(enumerate(ODD)) + [(60 + i, prose(20, 60 + i) + passage + prose(20, 90 + i)) for i in range(5)]
    keyed += [(70, passage[:150]), (71, "y" * 500), (72, prose(300, 8)), (72, prose(300, 8)), (None, prose(300, 8))]
    check(documents(keyed), keyed, 200)


def test_texts_lose_whole_characters_and_rows_stay(documents):
    passage = "é" * 150
    keyed = [(1, "aéb" + passage + "tail"), (2, passage + "é"), (3, None), (4, "short")]
    df = documents(keyed)
    got = {r.doc_id: r for r in remove_repeats(df, size="n_chars").collect()}
    assert remove_repeats(df).schema == df.schema
    assert got[1].text == "aébtail" and got[1].n_chars == 7 and got[2].text == "" and got[2].n_chars == 0
    assert got[3].text is None and got[4].text == "short" and got[4].row == 7


def test_empty_table(documents):
    assert measure_repeats(documents([(1, "a")]).filter("doc_id = 0")).collect() == []


def test_merge_is_a_sorted_order_with_right_prefixes():
    rng = random.Random(1)
    items = [("".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))).encode(), b"", i, i, 1) for i in range(500)]
    for runs in (1, 2, 3, 7):
        parts = [sorted(items[i::runs]) for i in range(runs)]
        merged = list(merge_runs([unpack_run(pack_run(p)) for p in parts]))
        keys = [m[1] for m in merged]
        assert keys == sorted(i[0] for i in items)
        for before, item in zip(merged, merged[1:]):
            common = 0
            while common < min(len(before[1]), len(item[1])) and before[1][common] == item[1][common]:
                common += 1
            assert item[0] == common
        assert sorted(m[3] for m in merged) == list(range(500))


def test_both_ways_of_comparing_contexts_agree(monkeypatch):
    from postflow.llm import suffix_dedup as sd
    rng = random.Random(6)
    for _ in range(30):
        texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(4, 30))).encode() for _ in range(14)]
        pairs = sorted({(t[c:c + 6], t[max(0, c - 4):c]) for t in texts for c in range(len(t))})
        classes, last = [], b""
        for right, left in pairs:
            classes.append([sd._common_prefix(last, right, 0), right, left, []])
            last = right
        monkeypatch.setattr(sd, "FEW_CONTEXTS", 10**9)
        plain = sd.class_spans(classes, 6, 10**9)
        monkeypatch.setattr(sd, "FEW_CONTEXTS", 0)
        assert plain == sd.class_spans(classes, 6, 10**9) and max(plain[1]) > 0


def test_kept_bytes():
    spans = [{"start": 5, "end": 7}, {"start": 1, "end": 3}, {"start": 2, "end": 4}, {"start": 7, "end": 8}]
    assert kept_bytes(b"0123456789", spans) == (b"0489", 2)
    assert kept_bytes(b"01", None) == (b"01", 0)
