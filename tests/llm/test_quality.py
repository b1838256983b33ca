"""Quality classifier: held-out accuracy, the linear-time identity, awkward rows."""

import zlib

import numpy as np

from llm import quality


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = quality.op4_quality(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    told = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in told]) > 0.9
    assert np.mean([b == 1 for a, b in told if a == 1]) > 0.98


def test_pairs_by_sums_of_squares():
    rng = np.random.default_rng(2)
    model = quality.Model()
    model.weights[:] = rng.normal(size=quality.SIZE)
    rows = [quality.features(t) for t in ("Some words here, and more words.", "x " * 40, "", "ÜBER!! ***")]
    for (index, value), score in zip(rows, model.scores(rows)):
        v = model.factors[index].astype(float) * value[:, None]
        logit = float(model.bias) + (model.weights[index] * value).sum() + sum(v[i] @ v[j] for i in range(len(v)) for j in range(i))
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-4


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 1), (7, 0), (12, 0), (12, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    model = quality.fit_quality(edge_docs, labels)
    rows = quality.quality_scores(edge_docs, model, ["doc_id", "text"]).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert quality.quality_scores(no_docs, model, ["doc_id"]).count() == 0
    nothing = quality.fit_quality(edge_docs, labels.where("false"))
    assert {r["score"] for r in quality.quality_scores(edge_docs, nothing, ["doc_id"]).collect()} == {0.5}
