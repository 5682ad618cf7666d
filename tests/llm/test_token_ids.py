import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ticklake.llm import token_ids
from ticklake.llm.token_ids import ChunkEncoder, EliasFano, TokenFile, packed, read_token_ids, write_token_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start int, ids binary, part string, ordinal long, content string"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**62), max_size=700), st.integers(0, 2**62))
def test_elias_fano_selects_and_counts(values, value):
    values = sorted(values)
    data = EliasFano.of(np.array(values, np.uint64)).to_bytes()
    found, end = EliasFano.read(memoryview(b"..." + data + b"."), 3)
    assert end == 3 + len(data) and found.values().tolist() == values
    assert [found.select(i) for i in range(len(values))] == values
    assert found.below(value) == bisect.bisect_left(values, value)


def test_elias_fano_is_near_minimal():
    r = random.Random(1)
    for n, top in ((100_000, 40_000_000), (50_000, 60_000), (70_000, 2**31)):
        values = np.array(sorted(r.randrange(top) for _ in range(n)), np.uint64)
        bits = 8 * len(EliasFano.of(values).to_bytes()) / n
        assert bits < 2.2 + max(0, np.log2(top / n)) + 0.9
    assert EliasFano.of(np.arange(3)).n == 3 and len(EliasFano.of(np.array([]))) == 0


def test_a_file_gives_any_document():
    docs = [np.arange(i % 7, dtype="<u2").tobytes() + b"\1\0" for i in range(900)]
    ids = [None, None, *range(-5, 2 * 898 - 5, 2)]
    file = TokenFile(packed(7, ids, docs, 2) + b"\n")
    assert file.ordinal == 7 and file.document_ids() == ids
    assert all(file.document(i).tobytes() == d for i, d in enumerate(docs))
    assert all(file.find(x).tobytes() == d for x, d in zip(ids[2:], docs[2:]))
    assert file.find(-4) is None and file.find(10**6) is None and file.find(-6) is None
    with pytest.raises(ValueError):
        TokenFile(packed(7, ids, docs, 2)[:-3])


ODD = [
    "İstanbul ΣΑΣ ΣΑΣ.", "a\x1cb c\x85d", "é ́x y  ẛ̣", "<|endoftext|>x <|startoftext|> <| endoftext|>",
    "it's  I'LL\t\n\r 'S x", "한국 각", " a　b c", "", " ", "\n\n", "ﬁ ǅ ŉ", "x" * 5000, "1234,56 $%& \U0001f600‍",
]


def test_chunks_give_the_ids_of_whole_texts(monkeypatch):
    whole, encoder = Tokenizer.from_file(PATH), ChunkEncoder(open(PATH, encoding="utf-8").read(), 2)
    assert encoder.safe
    r = random.Random(2)
    texts = ODD + [" ".join(r.choice(ODD + ["the", "Cat,", "of"]) for _ in range(40)) for _ in range(30)]
    for window, remembered in ((1 << 22, 1 << 20), (50, 2000)):  # windows inside texts, generations
        monkeypatch.setattr(token_ids, "WINDOW", window)
        monkeypatch.setattr(token_ids, "REMEMBERED_BYTES", remembered)
        for _ in range(2):
            found = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)]
            assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    encoder.safe = False
    assert [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)] == found


def test_only_chunks_that_occur_again_are_remembered():
    whole, encoder = Tokenizer.from_file(PATH), ChunkEncoder(open(PATH, encoding="utf-8").read(), 2)
    texts = [" ".join(f"once{i}x{j} the cat{i % 3}" for j in range(50)) for i in range(40)]
    for _ in range(2):
        found = [np.frombuffer(x, "<u2").tolist() for x in encoder.encode(texts)]
        assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert set(encoder.places) == {"the", "cat0", "cat1", "cat2"}
        assert len(encoder.ends) == 5 and len(encoder.ids) == encoder.ends[-1]


@pytest.mark.parametrize("file_ids, file_docs, parts", [(1 << 22, 1 << 18, 4), (60, 5, 3)])
def test_documents_read_back_equal_the_library(spark, scratch, monkeypatch, file_ids, file_docs, parts):
    monkeypatch.setattr(token_ids, "FILE_IDS", file_ids)
    monkeypatch.setattr(token_ids, "FILE_DOCS", file_docs)
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["the", "Cat,", "sat", "x9", "Été"]) for _ in range(r.randrange(30)))) for i in range(-40, 200, 3)]
    rows += [(500 + i, t) for i, t in enumerate(ODD)] + [(700, None), (2**62, "far"), (None, "no id"), (None, "none")]
    rows += [(50, "again")] * 2 + [(51, f"hot {i}") for i in range(150)] + [(701, "long " * 20_000)]  # an id with a third of all rows
    r.shuffle(rows)
    docs = spark.createDataFrame([(i, t, 1, b"x", "p", 2, "c") for i, t in rows], SCHEMA)
    path = scratch("ids")
    write_token_ids(docs, path, PATH, 1, parts=parts)
    out = read_token_ids(spark, path).orderBy("start").collect()
    whole = Tokenizer.from_file(PATH)
    ids = lambda t: [*whole.encode(t or "", add_special_tokens=False).ids, 1]
    assert sorted(((x.doc_id, list(x.token_ids)) for x in out), key=str) == sorted(((i, ids(t)) for i, t in rows), key=str)
    start = 0
    for before, x in zip([None, *out], out):
        assert x.start == start and x.n_tokens == len(x.token_ids)
        assert x.ids_crc32 == zlib.crc32(np.array(x.token_ids, "<u4").tobytes())
        assert before is None or before.doc_id is None or before.doc_id <= x.doc_id  # nulls first, ids ascend
        start += x.n_tokens
    index = spark.read.parquet(f"{path}/index")
    assert index.agg({"n_docs": "sum"}).first()[0] == len(rows) and (file_docs > 5 or index.count() > len(rows) / 5)


def test_an_empty_table_and_wide_ids(spark, scratch):
    path = scratch("ids")
    write_token_ids(spark.createDataFrame([], "doc_id long, text string"), path, PATH, 1)
    assert read_token_ids(spark, path).count() == 0
    path = scratch("ids")
    write_token_ids(spark.createDataFrame([(1, "a cat")], "doc_id long, text string"), path, PATH, 70_000)
    assert read_token_ids(spark, path).first().token_ids[-1] == 70_000
