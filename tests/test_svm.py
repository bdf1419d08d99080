"""The squared-hinge machine against a dense solver, and its model as part of a saved pipeline."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textsignal.operators import svm


def exact(x, y, strength):
    """Newton steps with halving on dense matrices, until the gradient vanishes."""
    x = np.hstack([x, np.ones((len(x), 1))])
    value = lambda w: w @ w / 2 + strength * (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()
    w = np.zeros(x.shape[1])
    for _ in range(200):
        short = np.maximum(0, 1 - y * (x @ w))
        slope = w - 2 * strength * x.T @ (y * short)
        if np.linalg.norm(slope) < 1e-10:
            break
        near = x[short > 0]
        step, rate = np.linalg.solve(np.eye(len(w)) + 2 * strength * near.T @ near, -slope), 1.0
        while value(w + rate * step) > value(w) + 1e-12 and rate > 1e-9:
            rate /= 2
        w = w + rate * step
    return w


def table(rng, n, size, classes, share=.3):
    x = rng.normal(size=(n, size)) * (rng.random((n, size)) < share)
    label = (x @ rng.normal(size=(size, classes)) + rng.normal(size=(n, classes))).argmax(1)
    x[3] = 0
    return x, label


def frame(spark, x, label):
    vector = lambda row, i: Vectors.dense(row) if i % 2 else Vectors.sparse(len(row), {int(j): float(row[j]) for j in np.flatnonzero(row)})
    return spark.createDataFrame([(float(l), vector(r, i)) for i, (r, l) in enumerate(zip(x, label))], ["label", "features"]).repartition(5)


@pytest.mark.parametrize("classes,strength", [(2, 1.0), (3, 1.0), (3, 20.0)])
def test_weights_are_those_of_an_exact_solver(spark, classes, strength):
    x, label = table(np.random.default_rng(classes), 300, 12, classes)
    model = svm.SquaredHingeSVM(strength=strength).fit(frame(spark, x, label))
    for c, m in enumerate(model.models):
        best = exact(x, np.where(label == c, 1.0, -1.0), strength)
        assert np.abs(np.append(m.coefficients.toArray(), m.intercept) - best).max() < 1e-4


def test_blocks_and_long_rows(spark, monkeypatch):
    """More features than a block and rows longer than a stretch give the same sums."""
    rng = np.random.default_rng(5)
    x, label = table(rng, 120, 40, 2)
    whole = svm.SquaredHingeSVM(tol=1e-7).fit(frame(spark, x, label)).models[1].coefficients.toArray()
    batch = next(iter(frame(spark, x, label).select(F.col("label").cast("int").alias("label"), F.unwrap_udt("features")["values"].alias("values"),
                                                    F.sequence(F.lit(0), F.size(F.unwrap_udt("features")["values"]) - 1).alias("indices")).toArrow().to_batches()))
    monkeypatch.setattr(svm, "ENTRIES", 7)
    assert sum(len(p[0]) for p in svm._pieces(batch)) == batch.num_rows
    asked = {1: (rng.normal(size=41), None), 0: (rng.normal(size=41), rng.normal(size=41))}
    small = list(svm._partial_sums(asked, 40)([batch]))
    monkeypatch.setattr(svm, "ENTRIES", 10 ** 6)
    large = list(svm._partial_sums(asked, 40)([batch]))
    for a, b in zip(small, large):
        assert np.allclose(np.frombuffer(a["sums"][0].as_py()), np.frombuffer(b["sums"][0].as_py()))
    monkeypatch.setattr(svm, "BLOCK", 16)
    parts = [np.frombuffer(b["sums"][0].as_py()) for b in svm._partial_sums(asked, 40)([batch]) if b["cls"][0].as_py() == 1]
    assert len(parts) == 3 and np.allclose(np.concatenate(parts), np.frombuffer(large[0]["sums"][0].as_py()))
    assert np.abs(whole - exact(x, np.where(label == 1, 1.0, -1.0), 1.0)[:-1]).max() < 1e-6


def test_model_predicts_and_is_saved(spark, tmp_path):
    x, label = table(np.random.default_rng(9), 200, 8, 3)
    data = frame(spark, x, label).withColumn("extra", F.lit(1))
    odd = data.unionByName(spark.createDataFrame([(None, Vectors.dense([1.0] * 8), 1), (1.0, None, 1)], data.schema))
    model = svm.SquaredHingeSVM().setLabelCol("label").fit(odd)
    scores = np.array([np.append(m.coefficients.toArray(), m.intercept) for m in model.models])
    path = str(tmp_path / "m")
    PipelineModel(stages=[model]).write().overwrite().save(path)
    for m in (model, PipelineModel.load(path)):
        for row in m.transform(data).collect():
            assert int(row["prediction"]) == int((scores[:, :-1] @ row["features"].toArray() + scores[:, -1]).argmax())
    with pytest.raises(ValueError):
        svm.SquaredHingeSVM().fit(data.limit(0))
