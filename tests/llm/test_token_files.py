import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_cases import ODD
from postflow.llm.token_files import TokenFile, WordTokenizer, read_token_files, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


def test_whole_texts_as_the_library(library):
    texts = [t for t in ODD if t] + ["ΣΑΣ. ΌΣΟΣ", "Ångström Å é", "ǅ ǆ İI ß ﬁ"]
    flat, first = WordTokenizer(open(PATH, encoding="utf-8").read()).encode_block([*texts, "", None])
    assert [flat[a:b].tolist() for a, b in zip(first, first[1:])] == [
        library.encode(t, add_special_tokens=False).ids for t in texts] + [[], []]


def test_round_trip_in_key_order(spark, documents, tmp_path, library):
    rows = [(i * 3 % 17, t) for i, t in enumerate(ODD)] + [(500, "same"), (500, "same"), (500, "other"), (None, "first")]
    path = f"file://{tmp_path}/ids"
    files = write_token_files(documents(rows), path, PATH)
    got = read_token_files(files, path, "crc", pa.int64(), lambda ids: zlib.crc32(ids.astype("<u4").tobytes())).collect()
    ids = {}
    for key, text in rows:
        ids.setdefault(key, []).append(library.encode(text or "", add_special_tokens=False).ids + [1])
    assert len(got) == len(rows)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        own = next(i for i in ids[r.doc_id] if zlib.crc32(np.array(i, "<u4").tobytes()) == r.crc)
        ids[r.doc_id].remove(own)
        assert (r.start, r.n_tokens) == (start, len(own))
        start += len(own)
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:])
    assert spark.read.parquet(f"{path}/files").count() == files.count()


def test_one_document_by_offset_and_dictionary_check(documents, tmp_path, library):
    path = f"file://{tmp_path}/ids"
    rows = [(i, f"document number {i} " * (i + 1)) for i in range(40)]
    names = [r.file for r in write_token_files(documents(rows), path, PATH).collect()]
    found = {}
    for name in names:
        file = TokenFile(path, name)
        for i in range(len(file.index)):
            found[int(file.index[i, 0])] = file.document(i).tolist()
    assert found == {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}
    (tmp_path / "ids" / "dictionary").write_bytes(b"another")
    with pytest.raises(ValueError, match="dictionary"):
        TokenFile(path, names[0])


def test_empty_table(documents, tmp_path):
    path = f"file://{tmp_path}/ids"
    files = write_token_files(documents([(1, "a")]).filter("doc_id = 0"), path, PATH)
    assert files.count() == 0
    assert read_token_files(files, path, "n", pa.int64(), len).collect() == []
