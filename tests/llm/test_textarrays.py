import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import ODD
from postflow.llm import textarrays as ta

TEXTS = st.lists(st.one_of(st.none(), st.text("aB é\t1-.", max_size=20)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_blocks_keep_documents_whole(texts, limit):
    seen = []
    for lo, hi, raw, off in ta.blocks(pa.array(texts, pa.string()), limit):
        assert lo == len(seen) and hi - lo == len(off) - 1
        seen += [raw[a:b].tobytes().decode() for a, b in zip(off, off[1:])]
    assert seen == [t or "" for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    by_value: dict = {}
    for _, _, raw, off in ta.blocks(pa.array(texts, pa.string())):
        starts, ends, first = ta.word_spans(raw, off, ta.NONSPACE)
        hashes = ta.span_hashes(raw, starts, ends)
        shingles, at = ta.shingles(hashes, first, 3)
        for d, (a, b) in enumerate(zip(off, off[1:])):
            own = word.findall(raw[a:b].tobytes().lower())
            assert [raw[s:e].tobytes().lower() for s, e in zip(starts[first[d]:first[d + 1]],
                                                                ends[first[d]:first[d + 1]])] == own
            wanted = [tuple(own[i:i + 3]) for i in range(len(own) - 2)] or ([tuple(own)] if own else [])
            got = shingles[at[d]:at[d + 1]].tolist()
            assert len(got) == len(wanted)
            for value, key in zip(got, wanted):
                assert by_value.setdefault(key, value) == value
    assert len(set(by_value.values())) == len(by_value)


def test_sliced_column():
    column = pa.array(ODD, pa.string()).slice(3, 6)
    found = [raw.tobytes().decode() for _, _, raw, _ in ta.blocks(column, 1)]
    assert found == [t or "" for t in ODD[3:9]]


def test_blocks_of_fewer_words_than_a_shingle():
    for text, count in (("a b", 1), ("a", 1), ("", 0), ("a b c d", 1), ("a b c d e", 1), ("a b c d e f", 2)):
        for _, _, raw, off in ta.blocks(pa.array([text], pa.string())):
            starts, ends, first = ta.word_spans(raw, off, ta.NONSPACE)
            assert len(ta.shingles(ta.span_hashes(raw, starts, ends), first, 5)[0]) == count
