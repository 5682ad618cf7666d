import math

import numpy as np
import pytest

from ticklake.llm import hard_negatives as hn
from ticklake.llm.hard_negatives import Index, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id long, row long, score int, scan int, vec string, anchor_id long"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 4, "v", 5) for r in rows], SCHEMA)


def sample(n=260, dim=20):
    r = np.random.default_rng(8)
    centres = r.standard_normal((4, dim))
    rows = []
    for i in range(n):
        x = centres[i % 4] * r.uniform(0, 2) + r.standard_normal(dim) * np.linspace(2, 0.1, dim)
        rows.append((i - 20, [float(v) for v in x], int(r.integers(0, 3))))
    rows += [(1000 + i, [0.5] * dim, i % 2) for i in range(20)]  # ties
    odd = [None, [], [None] * dim, [math.nan] * dim, [math.inf] * dim, [1.0] * 3, [-1.0, 2.0, 0.5], [0.0] * dim]
    rows += [(2000 + 5 * i, v, 1) for i, v in enumerate(odd)] + [(3000, rows[0][1], None), (None, rows[0][1], 1)]
    return rows + [(0, [0.25] * dim, 0), (0, [0.25] * dim, 0), (5, [9.0] * dim, 2)]  # repeat ids of anchors


def brute_force(rows, every, positives, negatives, scale=256.0):
    usable = []
    for at, (i, v, label) in enumerate(rows):
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, label, [math.floor(scale * x) for x in v], at))
    anchors = {}
    for i, label, v, at in usable:
        if i % every == 0 and (i not in anchors or (label, v, at) < anchors[i]):
            anchors[i] = (label, v, at)
    out = []
    for a, (label, v, at) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, own, lab) for j, lab, w, own in usable if own != at and len(w) == len(v))
        for p, j, _, _ in [x for x in scored if x[3] == label][:positives]:
            found = [(s, n) for s, n, _, lab in scored if lab != label and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(a, j, k + 1, n, -p, -s) for k, (s, n) in enumerate(found[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("every, scan_bytes, rows_at_once", [(5, 32 << 20, 2048), (3, 8000, 7)])
def test_negatives_equal_brute_force(spark, monkeypatch, every, scan_bytes, rows_at_once):
    monkeypatch.setattr(hn, "SCAN_BYTES", scan_bytes)
    monkeypatch.setattr(hn, "ROWS", rows_at_once)
    rows = sample()
    out = hard_negatives(vectors(spark, rows), every=every, positives=4, negatives=3)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute_force(rows, every, 4, 3)
    assert sorted(map(tuple, out.collect())) == expected and len(expected) > 300


def test_an_empty_table_and_anchors_without_windows(spark):
    assert hard_negatives(vectors(spark, [])).count() == 0
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, [0.0, -1.0], 2), (4, [0.5, 0.0], 2)]
    assert sorted(map(tuple, hard_negatives(vectors(spark, rows)).collect())) == [(0, 2, 1, 3, 0, 0)]  # a window of 0 only


@pytest.mark.parametrize("share", [0.9, 0.5, 0.1, -0.5])
def test_join_equals_all_products(share):
    r = np.random.default_rng(9)
    rows, anchors = (np.floor(256 * r.standard_normal((n, 37)) * np.linspace(3, 0.2, 37)) for n in (400, 30))
    exact = anchors @ rows.T
    least = exact.max(axis=1) * share
    allowed = r.random(exact.shape) < 0.7
    index = Index(rows, anchors, least)
    a, x, score = index.join(np.arange(30), least, allowed)
    found = {(i, j): s for i, j, s in zip(a, x, score)}
    assert found == {(i, j): exact[i, j] for i, j in zip(*np.nonzero(allowed & (exact >= least[:, None])))}
    if share == 0.9:
        assert index.indexed.mean() < len(index.groups) - 1  # covered dimensions are omitted
        assert sum(index.postings) < 0.8 * 400 * len(index.groups)
    if share < 0:
        assert (index.indexed == len(index.groups)).all()
