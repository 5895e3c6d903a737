import hashlib
import random
import time

import public_tokenizers
import tiktoken

from llm_cases import ODD
from postflow.llm.byte_bpe import LONG, HeapMerge, decode, digests, encode, read_ranks

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_ids_and_bytes_as_the_tiktoken_library(documents):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS),
                                special_tokens={})
    rows = list(enumerate(ODD)) + [(3, "again and again"), (3, "again and again"), (None, "no key")]
    wanted = sorted((repr(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    for memo in (500_000, 3, 0):
        got = encode(documents(rows), RANKS, memo_words=memo)
        assert sorted((repr(r.doc_id), list(r.ids)) for r in got.collect()) == [w[:2] for w in wanted]
    back = decode(got, RANKS).collect()
    assert sorted((repr(r.doc_id), bytes(r.data)) for r in back) == sorted((w[0], w[2]) for w in wanted)
    finish, schema = digests(RANKS, with_ids=True)
    hashed = encode(documents(rows), RANKS, memo_docs=5, finish=finish, schema=schema).collect()
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, list(r.ids)) for r in hashed) == sorted(
        (k, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(d).hexdigest(), i)
        for k, i, d in wanted)


def test_long_words_as_the_tiktoken_library(documents):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(RANKS),
                                special_tokens={})
    pick = random.Random(4)
    texts = ["".join(pick.choice(letters) for _ in range(n)) for letters in ("abcdefghijklmnopqrstuvwxyz", "ab", "日本語漢字仮名", "éèaàt")
             for n in (LONG - 1, LONG, LONG + 1, 3000)] + ["a" * 100_000, "the" * 40_000, "x" * LONG + " " + "y" * LONG]
    texts += ["".join(pick.choice("etaoinshrdlu") for _ in range(100_000))] * 2
    merge = HeapMerge(RANKS)
    for t in texts[:16]:
        assert merge(t.encode()) == library.encode_ordinary(t)
    began = time.time()
    got = {r.doc_id: list(r.ids) for r in encode(documents(list(enumerate(texts))), RANKS).collect()}
    assert time.time() - began < 120
    assert all(got[i] == library.encode_ordinary(t) for i, t in enumerate(texts))


def test_empty_table_and_null(spark, documents):
    assert encode(documents([(1, "a")]).filter("doc_id = 0"), RANKS).collect() == []
    row = encode(documents([(1, None)]), RANKS).first()
    assert row.ids == []
    ids = spark.createDataFrame([(1, None, "x"), (None, [], "y")], "doc_id long, ids array<int>, data string")
    back = {r.doc_id: r.data if r.data is None else bytes(r.data) for r in decode(ids, RANKS).collect()}
    assert back == {1: None, None: b""}
