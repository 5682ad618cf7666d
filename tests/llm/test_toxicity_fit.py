"""The fit against a plain loop, its calibration against a search, and what the scores are worth on the given labels."""

import math
import os
import zlib

import numpy as np
import pytest

from ticklake.llm import toxicity as tox

SF = "/root/testdata/sf0.1"
BIAS = 1 << tox.DIM_BITS


def examples(n=120, seed=4):
    r = np.random.default_rng(seed)
    labels = np.arange(n) % 3 == 0
    return [(np.unique(np.r_[r.integers(0, 50, 12), [60 + r.integers(0, 3)] if y else []]).astype(np.int32), float(y)) for y in labels]


def test_fit_equals_a_plain_loop():
    rows, model = examples(), tox.Ftrl()
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= model.l1:
            return 0.0
        shrunk = z[i] - math.copysign(model.l1, z[i])
        return -shrunk / ((model.beta + math.sqrt(n[i])) / model.alpha + model.l2)

    order = np.random.default_rng(1)
    for _ in range(tox.EPOCHS):
        for k in order.permutation(len(rows)):
            at = [*rows[k][0].tolist(), BIAS]
            held = {i: weight(i) for i in at}
            g = 1 / (1 + math.exp(-sum(held.values()))) - rows[k][1]
            for i in at:
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / model.alpha * held[i]
    at, weights = tox.fit(rows)
    plain = {i: w for i in z if (w := weight(i))}
    assert dict(zip(at.tolist(), weights)) == pytest.approx(plain) and len(plain) > 3


@pytest.mark.parametrize("spread", [0.5, 3.0, 1e6])
def test_calibration_is_the_likeliest_line(spread):
    r = np.random.default_rng(2)
    labels = (r.random(400) < 0.2).astype(float)
    scores = (labels * 2 - 1.3 + r.normal(0, 0.7, 400)) * spread
    slope, offset = tox.calibration(scores, labels)

    def loss(a, b):
        z, toxic = a * np.clip(scores, -35, 35) + b, labels.sum()
        wanted = np.where(labels == 1, (toxic + 1) / (toxic + 2), 1 / (len(labels) - toxic + 2))
        return (np.logaddexp(0, z) - wanted * z).sum() + ((a - 1) ** 2 + b**2) / 2

    best = loss(slope, offset)
    assert slope > 0 and all(best <= loss(slope + a, offset + b) + 1e-9 for a in (-0.01, 0, 0.01) for b in (-0.01, 0, 0.01))


def test_calibrated_scores_keep_the_order_and_small_samples_their_scores():
    rows = examples()
    (at, weight), (at2, weight2) = tox.fit(rows), tox.calibrated_fit(rows)
    plain, scaled = dict(zip(at.tolist(), weight)), dict(zip(at2.tolist(), weight2))
    plain.pop(BIAS, None), scaled.pop(BIAS)
    slopes = {round(scaled[i] / w, 9) for i, w in plain.items()}
    assert scaled.keys() == plain.keys() and len(slopes) == 1 and slopes.pop() > 0
    few = [(x, float(i < tox.CALIBRATED_FROM - 1)) for i, (x, _) in enumerate(rows)]
    assert all(np.array_equal(a, b) for a, b in zip(tox.fit(few), tox.calibrated_fit(few)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_held_out_recall_on_the_given_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = tox.toxicity(docs, labels).where("held_out").select("doc_id", "predicted").join(labels.where("toxic in (0, 1)"), "doc_id")
    rows = out.select("doc_id", "toxic", "predicted").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    toxic = [r.predicted for r in rows if r.toxic]
    clean = [r.predicted for r in rows if not r.toxic]
    assert len(toxic) > 100 and sum(toxic) >= 0.8 * len(toxic) and sum(clean) < 0.01 * len(clean)
