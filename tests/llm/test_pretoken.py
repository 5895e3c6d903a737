"""Class-based pre-tokens against the regular expressions they stand for."""

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import ODD
from postflow.llm import pretoken

ALPHABET = "ab'stmdrevl LÉß日1٣Ⅷ½ \t\n 　.,!-_́‍🙂"
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def tokens(texts, split, drop):
    parts = [t.encode() for t in texts]
    raw = np.frombuffer(b"".join(parts), np.uint8)
    off = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
    codes, first, data, at, hashes = pretoken.distinct_tokens(raw, off, pretoken.Classes(), split, drop)
    assert len(hashes) == len(at) - 1
    known = [data[a:b].tobytes().decode() for a, b in zip(at, at[1:])]
    assert len(set(known)) == len(known)
    return [[known[c] for c in codes[a:b]] for a, b in zip(first, first[1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(ALPHABET), max_size=12), max_size=5))
def test_splits(texts):
    byte_level = regex.compile(public_tokenizers.PATTERN)
    word = regex.compile(WORD)
    assert tokens(texts, pretoken.byte_level_starts, False) == [byte_level.findall(t) for t in texts]
    assert tokens(texts, pretoken.word_starts, True) == [word.findall(t) for t in texts]


@pytest.mark.parametrize("text", [t for t in ODD if t])
def test_odd_texts(text):
    assert tokens([text], pretoken.byte_level_starts, False) == [regex.findall(public_tokenizers.PATTERN, text)]
    assert tokens([text], pretoken.word_starts, True) == [regex.findall(WORD, text)]
