import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ticklake.llm.bpe import Bpe, LiveEncoding, bpe_digests, decoded, encoded, read_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
BPE = Bpe(read_ranks(PATH), PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=BPE.ranks, special_tokens={})
TEXTS = st.text(st.one_of(st.sampled_from("ab's t'lle \n\t12é中🎉-!"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_encodes_as_the_library_and_decodes_exactly(text):
    ids = BPE.encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert BPE.decode(ids) == text.encode()
    assert [p for block in BPE.pieces(text, 4) for p in block] == BPE.pattern.findall(text)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 6), st.text("ab' lre12é", max_size=5)), max_size=5))
def test_appends_and_edits_equal_a_fresh_encoding(text, edits):
    live = LiveEncoding(BPE, text)
    for start, length, new in edits:
        start = min(start, len(text))
        end = min(len(text), start + length)
        text = text[:start] + new + text[end:]
        live.edit(start, end, new)
        assert live.text == text and live.ids() == REFERENCE.encode_ordinary(text)
    live.append("'ll")
    assert live.ids() == REFERENCE.encode_ordinary(text + "'ll")


def test_an_edit_redoes_little():
    live = LiveEncoding(BPE, "some words in a long text " * 500 + "abcdefghij" * 3000)
    whole = live.redone
    live.append("xyz")
    assert live.redone <= 3
    live.edit(20, 21, "q")
    assert live.redone < 30 < whole
    assert live.ids() == REFERENCE.encode_ordinary(live.text)


def test_a_piece_takes_one_path_with_few_pairs_looked_at(monkeypatch):
    r = random.Random(4)
    pieces = [" " + "".join(r.choice(["th", "an", "ing", "re", "x", "é", "qu", "中"]) for _ in range(r.randrange(1, 9))) for _ in range(2000)]
    pieces += [" " * 300, "a" * 3000, "ab" * 500, "\U0001f600" * 40, "lele" * 99 + "e"]
    rows = [BPE.tokens(last) for piece in pieces if [*BPE.extend(piece.encode().decode("latin-1"), last := [], 0)]]
    pairs = []
    monkeypatch.setattr(BPE, "stable", type("Pairs", (), {"__getitem__": lambda _, pair: pairs.append(pair) or BPE._follows(pair)})())
    assert [list(BPE._piece(piece)) for piece in pieces] == rows == [REFERENCE.encode_ordinary(piece) for piece in pieces]
    assert len(pairs) < 2.5 * sum(map(len, rows))  # the table looks at several pairs for each byte


def test_digests(docs):
    rows = [(1, None), (2, ""), (3, "Hello, wörld 🎉"), (3, "Hello, wörld 🎉"), (None, "a  b"), (5, "word " * 50_000 + "x" * 100_000)]
    out = bpe_digests(docs(rows).withColumnRenamed("n", "n_tokens"), "text", PATH, PATTERN).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = REFERENCE.encode_ordinary(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert bpe_digests(docs([]), "text", PATH, PATTERN).count() == 0


def test_ids_round_trip(docs):
    df = docs([(1, None), (2, ""), (3, "Hello, wörld 🎉")])
    out = decoded(encoded(df, "text", PATH, PATTERN), "token_ids", PATH, PATTERN)
    assert {r.doc_id: r.decoded for r in out.collect()} == {1: "", 2: "", 3: "Hello, wörld 🎉"}


def test_a_damaged_rank_file_is_an_error(tmp_path):
    (tmp_path / "ranks").write_text("no rank here")
    with pytest.raises(ValueError):
        Bpe(read_ranks(str(tmp_path / "ranks")), PATTERN)
