import random

import numpy as np
import pandas as pd
import pytest

from ticklake.llm import suffix_dedup
from ticklake.llm.suffix_dedup import LENGTH, WINDOW, anchors, common_words, pieces, repeated_passages


def brute(rows):
    words, seen = {}, {}
    for i, text in rows:
        words[i] = (text or "").encode().lower().split()
    windows = {i: [tuple(w[p : p + LENGTH]) for p in range(len(w) - LENGTH + 1)] for i, w in words.items()}
    for i, ws in windows.items():
        for w in ws:
            seen.setdefault(w, set()).add(i)
    out = []
    for i, ws in windows.items():
        span = None
        for p, w in enumerate(ws):
            if len(seen[w]) > 1:
                first = min(seen[w])
                if span and p <= span[1]:
                    span = [span[0], p + LENGTH, min(span[2], first)]
                else:
                    out += [(i, *span)] if span else []
                    span = [p, p + LENGTH, first]
        out += [(i, *span)] if span else []
    return sorted(out)


def texts():
    r = random.Random(8)
    prose = lambda n: [f"w{r.randrange(3000)}" for _ in range(n)]
    shared = [prose(n) for n in (49, 50, 51, 80, 300)]
    out = []
    for _ in range(60):
        text = prose(r.randrange(0, 120))
        for _ in range(r.randrange(3)):
            text += r.choice(shared) + prose(r.randrange(30))
        out.append(" ".join(text))
    changed = shared[4][:100] + ["other"] + shared[4][101:]
    out += [out[3], out[3].upper(), out[5], " ".join(changed), " ".join(shared[0]), "", None, " ".join(["again"] * 200), " ".join(["again"] * 90)]
    out += [" ".join(prose(30) * 5), " ".join(prose(20_000) + shared[2])]  # repeats within itself only; long
    return out


@pytest.mark.parametrize(("piece", "many", "places", "coalesce"), [(20_000, 1000, 1 << 20, True), (20_000, 1, 0, False), (2, 2, 1 << 20, True)])
def test_passages_equal_brute_force(spark, docs, monkeypatch, piece, many, places, coalesce):
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_PLACES", places)
    rows = list(enumerate(texts()))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, str(coalesce).lower())  # without it the array is cut into partitions here too
    try:
        out = repeated_passages(docs(rows)).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((r.doc_id, r.start_word, r.end_word, r.first_id) for r in out) == brute(rows)
    assert all(r.n_words == r.end_word - r.start_word >= LENGTH for r in out)


def test_every_window_has_one_anchor():
    words = np.random.default_rng(8).integers(0, 40, 500).astype(np.uint64)  # many ties
    places, first, last = anchors(words, chunk=64)
    assert [s for a, b in zip(first, last) for s in range(a, b + 1)] == list(range(500 - LENGTH + 1))
    assert ((first <= places) & (places - first < WINDOW) & (last <= places)).all()
    for chosen, other in zip(anchors(words), (places, first, last)):
        assert (chosen == other).all()
    assert [len(x) for x in anchors(words[: LENGTH - 1])] == [0, 0, 0]


@pytest.mark.parametrize("size", [1, 3, 100])
def test_pieces_hold_all_rows_and_mark_cut_intervals(size):
    names = [1] * 4 + [2] * 2 + [3] * 9 + [4] + [5] * 3
    frame = pd.DataFrame({"head": 0, "name": names, "row": range(len(names))})
    got = list(pieces((frame.iloc[a : a + size] for a in range(0, len(frame), size)), 5))
    assert [r for f, _ in got for r in f["row"]] == list(range(len(names)))
    cut = {n for f, c in got for n in f["name"][c]}
    assert {1, 5} <= cut and not cut & {2, 4}  # the partition's borders, and what is small
    for name in {1, 2, 3, 4, 5} - cut:
        assert sum(name in set(f["name"]) for f, _ in got) == 1


def test_neighbours_common_words():
    assert common_words(np.array([[1, 2, 3], [1, 2, 4], [1, 2, 4], [2, 2, 4]])).tolist() == [2, 3, 0]


def test_repeated_rows_null_ids_and_an_empty_table(docs):
    text = " ".join(f"word{i}" for i in range(60))
    assert repeated_passages(docs([(1, text), (1, text), (None, text), (2, "x " + text[:100])])).count() == 0
    out = repeated_passages(docs([(4, text), (4, text), (2, text), (2, text)])).collect()
    assert sorted(map(tuple, out)) == [(2, 0, 60, 60, 2), (4, 0, 60, 60, 2)]
    assert repeated_passages(docs([])).count() == 0


def test_only_intervals_too_large_for_a_task_are_cut(spark, docs, monkeypatch):
    r = random.Random(4)
    shared = [f"w{r.randrange(3000)}" for _ in range(60)]
    rows = [(i, " ".join([f"a{i}", *shared, f"b{i}"])) for i in range(300)]
    settled, settle = spark.sparkContext.accumulator(0), suffix_dedup._settle

    def counted(suffixes, found):
        settled.add(len(suffixes))
        return settle(suffixes, found)

    monkeypatch.setattr(suffix_dedup, "_settle", counted)
    monkeypatch.setattr(suffix_dedup, "MANY", 1)
    for piece, some in ((20_000, False), (100, True)):
        monkeypatch.setattr(suffix_dedup, "PIECE", piece)
        settled.value = 0
        out = repeated_passages(docs(rows)).collect()
        assert sorted(map(tuple, out)) == [(i, 1, 61, 60, 0) for i in range(300)]
        assert (settled.value > 0) == some
