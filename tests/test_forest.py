"""The forest for rows that are mostly zero, against brute force."""
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors

from textsignal.operators import classify as C, forest as FO
from textsignal.operators.packing import unpack


def _rows(spark, n=300, size=12, classes=3, seed=5):
    """Rows with some values, also below zero, whose class shows in two features."""
    draw, out = np.random.default_rng(seed), []
    for _ in range(n):
        y = int(draw.integers(classes))
        index = np.union1d(draw.integers(0, size, 3), [y] if draw.random() < .7 else [])
        out.append((Vectors.sparse(size, index.tolist(), np.round(draw.normal(size=len(index)) + y, 1).tolist()), float(y)))
    return out, spark.createDataFrame(out, ["features", "label"]).repartition(3)


def _gini(y, w):
    n = np.bincount(y, w)
    return 1 - ((n / n.sum()) ** 2).sum()


def test_cuts_lie_between_values_and_zeros_count():
    values, uses = np.array([-1.0, 2.0, 4.0]), np.array([1, 1, 1])
    assert FO._cuts(values, uses, 5, 31).tolist() == [-0.5, 1.0, 3.0]
    assert FO._cuts(values, uses, 0, 31).tolist() == [0.5, 3.0]
    assert FO._cuts(np.array([0.0, 1.0]), uses[:2], 5, 31).tolist() == [0.5]
    even = FO._cuts(np.arange(100.0), np.ones(100, int), 0, 3)
    assert even.tolist() == [24.5, 49.5, 74.5]


def test_subsets_are_different_features():
    some = FO._subsets(500, 20, 15, np.random.default_rng(1))
    assert some.shape == (500, 15) and all(len(set(r)) == 15 for r in some.tolist()) and set(some.ravel().tolist()) == set(range(20))
    assert FO._subsets(2, 3, 5, None).tolist() == [[0, 1, 2]] * 2


@pytest.mark.parametrize("cells", [4_000_000, 1])
def test_every_split_is_the_best_one(spark, monkeypatch, cells):
    """One tree of all features: the split of every node has the gain of the best of all splits of its rows."""
    monkeypatch.setattr(FO, "CELLS", cells)
    monkeypatch.setattr(FO, "COPIES", np.array([-1.0, 2.0]))     # every row once
    data, df = _rows(spark)
    model = FO.SparseForest(numTrees=1, maxDepth=4, seed=3).fit(df)
    assert isinstance(model, RandomForestClassificationModel) and model.getNumTrees == 1 and model.numClasses == 3
    x, y = np.array([v.toArray() for v, _ in data]), np.array([int(c) for _, c in data])
    node, rows, seen = model.trees[0]._call_java("rootNode"), np.arange(len(y)), 0
    walk = [(node, rows)]
    while walk:
        node, rows = walk.pop()
        if node.getClass().getSimpleName() == "LeafNode":
            # Leaves of one class are merged, so a leaf may hold several; its prediction is the commonest.
            assert np.bincount(y[rows], minlength=3)[int(node.prediction())] == np.bincount(y[rows]).max()
            continue
        best = 0.0
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            middle = (values[1:] + values[:-1]) / 2
            for cut in (middle if len(middle) <= 31 else []):
                low = x[rows, f] <= cut
                if 0 < low.sum() < len(rows):
                    best = max(best, _gini(y[rows], None) - low.mean() * _gini(y[rows][low], None) - (~low).mean() * _gini(y[rows][~low], None))
        low = x[rows, node.split().featureIndex()] <= node.split().threshold()
        gain = _gini(y[rows], None) - low.mean() * _gini(y[rows][low], None) - (~low).mean() * _gini(y[rows][~low], None)
        assert gain == pytest.approx(node.gain(), abs=1e-9) and gain >= best - 1e-9
        seen += 1
        walk += [(node.leftChild(), rows[low]), (node.rightChild(), rows[~low])]
    assert seen > 3


def test_forest_does_what_mllibs_does_and_is_saved(spark, tmp_path):
    data, df = _rows(spark, 900)
    _, other = _rows(spark, 900, seed=6)
    right = lambda m: m.transform(other).filter("prediction = label").count() / 900
    ours, theirs = (kind(numTrees=25, maxDepth=6, seed=2, cacheNodeIds=True).fit(df) for kind in (FO.SparseForest, RandomForestClassifier))
    assert right(ours) > right(theirs) - .04 and right(ours) > .6
    assert .8 < ours.totalNumNodes / theirs.totalNumNodes < 1.25 and max(t.depth for t in ours.trees) == 6
    ours.write().save(str(tmp_path / "m"))
    again = RandomForestClassificationModel.load(str(tmp_path / "m"))
    assert [r["probability"] for r in again.transform(df).collect()] == [r["probability"] for r in ours.transform(df).collect()]
    assert FO.SparseForest(numTrees=25, maxDepth=6, seed=2).fit(df).totalNumNodes == ours.totalNumNodes


def test_rows_of_one_class_or_without_values(spark):
    one = spark.createDataFrame([(Vectors.dense([1.0, 0.0]), 1.0), (Vectors.sparse(2, [], []), 1.0)] * 3, ["features", "label"])
    model = FO.SparseForest(numTrees=3, maxDepth=3, seed=1).fit(one)
    assert {r["prediction"] for r in model.transform(one).collect()} == {1.0} and model.totalNumNodes == 3


def test_rows_travel_without_their_zeros(spark, monkeypatch):
    """Of a thousand features a row keeps the few that it has."""
    kept = []
    stored = FO.stored

    def look(df, name):
        out = stored(df, name)
        if name == "forest-rows":
            kept.extend(unpack(r["bag"]) for r in out.collect())
        return out
    monkeypatch.setattr(FO, "stored", look)
    df = spark.createDataFrame([(Vectors.sparse(1000, [i % 50, 50 + i % 7], [1.0, 2.0]), float(i % 2)) for i in range(200)], ["features", "label"])
    C.random_forest(trees=2, max_depth=2).fit(df)
    assert sum(len(bag[0]) for bag in kept) == 200 and sum(len(bag[2]) for bag in kept) == 400


def test_terms_are_counted_once_for_all_kinds_of_features(spark, monkeypatch):
    calls, fit = [], C.fit_counts
    monkeypatch.setattr(C, "fit_counts", lambda *a, **k: calls.append(a[2]) or fit(*a, **k))
    df = spark.createDataFrame([(f"p{i:03d}", ("rain storm night " if i % 2 else "sun calm day ") * (1 + i % 3), "ab"[i % 2]) for i in range(60)], "id string, text string, label string")
    models = {"a": (C.BOW, 2, C.logistic_regression(50)), "b": (C.TFIDF, 2, C.logistic_regression(50)), "c": (C.TFIDF, 1, C.random_forest(3, 2))}
    scores, preds, fitted, _ = C.train_and_rank(df, "text", "label", "id", models=models)
    assert calls == [2, 1] and scores.count() == 3 and {s.uid for s in fitted["a"].stages[:4]} == {s.uid for s in fitted["b"].stages[:4]}
