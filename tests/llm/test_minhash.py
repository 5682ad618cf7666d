import random

import numpy as np
import pytest

from ticklake.llm import minhash
from ticklake.llm.common import connected_components
from ticklake.llm.minhash import estimated_jaccard, near_duplicates, registers
from ticklake.llm.shingles import mixed


def brute(rows, k, percent=80):
    """(n, component) by id, from all pairs."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    low = {i: i for i in sets}
    while True:
        before = dict(low)
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    low[a] = min(low[a], low[b])
        if low == before:
            return {i: (len(sets[i]), low[i]) for i in sets}


def family(seed, n, size, changes):
    """Texts that drift away from each other by a few words a step."""
    r = random.Random(seed)
    text, out = [f"w{r.randrange(500)}" for _ in range(size)], []
    for _ in range(n):
        for _ in range(changes):
            text[r.randrange(size)] = f"w{r.randrange(500)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(docs, k, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 900)  # several blocks of a bucket
    texts = family(1, 40, 60, 3) + family(2, 30, 150, 2) + family(3, 20, 12, 1)
    texts += ["one two three", "One  TWO\tthree", "one two three four", "solo", "SOLO", "", None, " \n ", "É x", "é x", "ü " * 20_000 + "end"]
    ids = list(range(len(texts)))
    random.Random(4).shuffle(ids)
    rows = list(zip(ids, texts))
    out = near_duplicates(docs(rows), shingle=k).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows, k)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_nulls_repeats_and_an_empty_table(docs):
    rows = [(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f"), (3, "a b c d e f"), (9, "x y z"), (9, "p q r s")]
    out = near_duplicates(docs(rows), shingle=2).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in out), key=str) == sorted(
        [(None, None, True), (7, 3, False), (7, 3, False), (3, 3, True), (9, 9, True), (9, 9, True)], key=str
    )
    assert near_duplicates(docs([])).count() == 0


def test_registers_merge_and_estimate():
    r = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.8, 0.95):
        found = []
        for _ in range(30):
            both = r.integers(0, 1 << 63, int(1000 * share)).astype(np.uint64)
            only = [r.integers(0, 1 << 63, 500 - len(both) // 2).astype(np.uint64) for _ in range(2)]
            a, b = (mixed(np.concatenate([both, x])) for x in only)
            ra, rb = registers(a), registers(b)
            assert (registers(np.concatenate([a, b])) == np.maximum(ra, rb)).all()
            size = np.array([float(len(a))])
            found.append(estimated_jaccard(size, size, np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), len(ra))[0])
        assert abs(np.mean(found) - share) < 0.03 and max(abs(x - share) for x in found) < minhash.MARGIN


def test_connected_components(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 600)]
    rows = path + star + [(7, 7), (None, 3), (2, 1), (1, 2)]
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    expected = {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 600)} | {1: 1, 2: 1}
    assert out == expected
