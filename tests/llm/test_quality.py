"""Held-out accuracy, and the density against a plain formula."""

import numpy as np

from tillroll.llm.queries import QUERIES
from tillroll.llm.quality import FEATURES, classify_quality, fit, with_statistics

from tests.llm.edge_rows import documents, empty


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = QUERIES["op7_quality"](spark, sf).filter("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 500 and np.mean([r.predicted == r.quality for r in rows]) > 0.97


def test_scores_follow_the_two_densities(spark):
    rng = np.random.default_rng(1)
    d = len(FEATURES)
    data = [(0, (rng.normal(size=d) * 2).tolist()) for _ in range(300)] + \
           [(1, (rng.normal(size=d) + 1).tolist()) for _ in range(500)]
    model = fit(spark.createDataFrame(data, "label int, features array<double>"))
    x = np.array([v for _, v in data])
    y = np.array([k for k, _ in data])
    assert ((model.score(x) > 0.5) == (y == 1)).mean() > 0.95
    z = (x[:5] - model.centre) / model.scale
    for row, got in zip(z, model.score(x[:5])):
        logs = [-0.5 * np.sum((f @ (row - m)) ** 2) - 0.5 * det
                for m, f, det in zip(model.means, model.factors, model.log_dets)]
        assert np.isclose(got, 1 / (1 + np.exp(-(logs[1] - logs[0] + np.log(500 / 300)))))


def test_edge_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 0), (5, 1), (6, 1), (6, 0), (7, None), (None, 1), (99, 1)],
                                   "doc_id long, label int")
    got = classify_quality(documents(spark), labels).collect()
    assert len(got) == 18 and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in classify_quality(documents(spark), labels.filter("label = 1")).collect()} == {1.0}
    assert {r.score for r in classify_quality(documents(spark), labels.limit(0)).collect()} == {0.5}
    assert classify_quality(empty(spark), labels).collect() == []
    assert all(len(r.features) == len(FEATURES) and np.isfinite(r.features).all()
               for r in with_statistics(documents(spark)).collect())
