"""The pipeline's stages over whole small tables, each against brute force on its own input."""

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from test_decontaminate import brute as brute_leaks
from test_suffix_dedup import brute as brute_repeats

from postflow.llm.byte_bpe import read_ranks
from postflow.llm.tables import staged


@pytest.fixture(scope="module")
def outputs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), "test-pipeline")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order_and_columns(outputs):
    assert len(corpus_pipeline.STAGES) == 5
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns and df.dtypes == outputs[0].dtypes


def test_classifier_keeps_clean_documents(spark, sf_dir, outputs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before, after = texts(outputs[0]), texts(outputs[1])
    assert all(before[i] == t for i, t in after.items())
    clean = [i in after for i, q in labels.items() if q == 1 and i in before]
    junk = [i in after for i, q in labels.items() if q == 0 and i in before]
    assert sum(clean) >= 0.97 * len(clean) and sum(junk) <= 0.1 * len(junk)


def test_near_duplicates(outputs):
    from test_near_dedup import brute
    before = sorted(texts(outputs[1]).items())
    comp, sizes = brute(before, 5, 80)
    wanted = {key for i, (key, _) in enumerate(before) if not sizes[i] or comp[i] == i}
    assert set(texts(outputs[2])) == wanted


def test_repeated_passages(outputs):
    before = texts(outputs[2])
    after = {r.doc_id: r for r in outputs[3].collect()}
    data, gone = brute_repeats(list(before.values()), 200)
    for key, x, g in zip(before, data, gone):
        kept = bytes(c for c, a in zip(x, g) if not a).decode(errors="ignore")
        assert after[key].text == kept and after[key].n_chars == len(kept)


def test_decontamination(spark, sf_dir, outputs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before = texts(outputs[3])
    bad = {d for d, *_ in brute_leaks(list(before.items()), items)}
    assert {repr(i) for i in texts(outputs[4])} == {repr(i) for i in before} - bad


def test_token_ids(outputs):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)))
    before = texts(outputs[4])
    got = {r.doc_id: list(r.ids) for r in outputs[5].collect()}
    assert got == {i: library.encode_ordinary(t or "") for i, t in before.items()}


def test_run_gives_the_same_rows(spark, sf_dir, outputs):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "ids_sha256").collect()
    assert sorted(got) == sorted(outputs[5].select("doc_id", "ids_sha256").collect())
