import random

import pytest

from ticklake.llm import toxicity as tox


def borderline(n=3600):
    """Of texts with one word four in ten are toxic, of those with another all."""
    r = random.Random(4)
    rows, labels = [], []
    for i in range(n):
        unsure, vile = i % 6 == 0, i % 24 == 1
        rows.append((i, "grim" if unsure else "vile" if vile else "calm"))
        labels.append((i, int(vile or (unsure and r.random() < 0.4))))
    return rows, labels


@pytest.mark.parametrize("limit", [10_000, 150])
def test_scores_mean_the_same_on_a_thinned_sample(spark, docs, monkeypatch, limit):
    monkeypatch.setattr(tox, "TRAIN_ROWS", limit)
    rows, labels = borderline()
    truth = dict(labels)
    held = [r for r in tox.toxicity(docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")).collect() if r.held_out]
    share = sum(truth[r.doc_id] for r in held) / len(held)
    assert sum(r.score for r in held) / len(held) == pytest.approx(share, abs=0.05)
    unsure = [r for r in held if r.text == "grim"]
    assert len(unsure) > 150
    assert sum(r.score for r in unsure) / len(unsure) == pytest.approx(0.4, abs=0.2)
    assert sum(r.predicted for r in unsure) <= 0.1 * len(unsure)
