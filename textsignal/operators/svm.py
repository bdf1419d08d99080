"""Linear support vector machine with squared hinge loss, one class against the rest.

For each class it minimises (|w|² + b²) / 2 + strength * sum(max(0, 1 - y (w x + b))²) with a trust-region Newton method
whose steps come from conjugate gradients (Lin, Weng & Keerthi 2008). Rows never leave their tasks: a pass over them
answers what every class asks next, as sums by blocks of features. The driver holds a few vectors of one number per
feature and class, bounded by the size of the dictionary.
"""
import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator
from pyspark.ml.classification import LinearSVC, LinearSVCModel, OneVsRest, OneVsRestModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.sql import functions as F

from textsignal.sources.writers import stored

BLOCK = 4096          # features in one partial sum
ENTRIES = 1_000_000   # non-zero values that a task looks at together
SUMS = "cls int, block int, loss double, sums binary"


def _pieces(batch):
    """(labels, row of each value, features, values) of stretches of a batch; a row with more values than a stretch is one of its own."""
    label = batch.column("label").to_numpy()
    features, values = batch.column("indices"), batch.column("values")
    ends = features.offsets.to_numpy()
    features, values = features.values.to_numpy(), values.values.to_numpy()
    start = 0
    while start < len(label):
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + ENTRIES, side="right")) - 1)
        rows = np.repeat(np.arange(stop - start), np.diff(ends[start:stop + 1]))
        yield label[start:stop], rows, features[ends[start]:ends[stop]], values[ends[start]:ends[stop]]
        start = stop


def _partial_sums(asked, size):
    """Task function: for each (class, weights, direction), loss and gradient at the weights, or, with a direction,
    its product with the second derivative there."""
    def work(batches):
        loss, sums = {c: 0.0 for c in asked}, {c: np.zeros(size + 1) for c in asked}
        for batch in batches:
            for label, rows, features, values in _pieces(batch):
                def dot(w):
                    return np.bincount(rows, values * w[features], minlength=len(label)) + w[size]
                for c, (weights, direction) in asked.items():
                    y = np.where(label == c, 1.0, -1.0)
                    short = np.maximum(0.0, 1.0 - y * dot(weights))
                    share = -2 * y * short if direction is None else np.where(short > 0, 2 * dot(direction), 0.0)
                    loss[c] += short @ short
                    sums[c][:size] += np.bincount(features, values * share[rows], minlength=size)
                    sums[c][size] += share.sum()
        for c in asked:
            for block, start in enumerate(range(0, size + 1, BLOCK)):
                yield pa.RecordBatch.from_pydict({"cls": pa.array([c], pa.int32()), "block": pa.array([block], pa.int32()), "loss": [loss[c]],
                                                  "sums": [sums[c][start:start + BLOCK].tobytes()]})
    return work


def _add(table):
    """One row for all tasks' sums of a block."""
    total = np.sum([np.frombuffer(s.as_buffer()) for s in table.column("sums")], axis=0)
    return pa.table({"cls": table.column("cls")[:1], "block": table.column("block")[:1],
                     "loss": pa.array([sum(table.column("loss").to_pylist())]), "sums": pa.array([total.tobytes()])})


def _answer(rows, asked, size):
    """{class: (loss, sums)} from one pass over all rows."""
    parts = rows.mapInArrow(_partial_sums(asked, size), SUMS).groupBy("cls", "block").applyInArrow(_add, SUMS).toArrow().to_pylist()
    out = {c: (0.0, np.zeros(size + 1)) for c in asked}
    for p in parts:
        out[p["cls"]][1][p["block"] * BLOCK:(p["block"] + 1) * BLOCK] = np.frombuffer(p["sums"])
        out[p["cls"]] = p["loss"], out[p["cls"]][1]
    return out


def _newton(size, strength, tol, max_steps):
    """Generator that asks for (weights, direction) and is sent (loss, sums); returns the weights.

    The objective curves by at least 1 in every direction, so weights whose gradient is shorter than `tol` are no further than `tol` from the best.
    """
    w = np.zeros(size + 1)
    loss, sums = yield w, None
    value, slope = w @ w / 2 + strength * loss, w + strength * sums
    radius = np.linalg.norm(slope)
    for _ in range(max_steps):
        length = np.linalg.norm(slope)
        if length <= tol:
            break
        step, rest, way, at_edge = np.zeros(size + 1), -slope, -slope, False
        while np.linalg.norm(rest) > max(0.1 * length, tol / 2):
            _, sums = yield w, way
            bent = way + strength * sums
            square = rest @ rest
            far = square / (way @ bent)
            if np.linalg.norm(step + far * way) >= radius:
                a, b, gap = way @ way, step @ way, radius ** 2 - step @ step
                far, at_edge = (np.sqrt(b * b + a * gap) - b) / a, True
            step, rest = step + far * way, rest - far * bent
            if at_edge:
                break
            way = rest + (rest @ rest) / square * way
        hoped = (step @ rest - slope @ step) / 2
        if hoped <= 1e-14 * value:   # below what sums of doubles can show
            break
        loss, sums = yield w + step, None
        new = w + step
        new_value = new @ new / 2 + strength * loss
        ratio = (value - new_value) / hoped
        if ratio < 0.25:
            radius = np.linalg.norm(step) / 4
        elif ratio > 0.75 and at_edge:
            radius *= 2
        if ratio > 1e-4:
            w, value, slope = new, new_value, new + strength * sums
    return w


def fit_weights(rows, size, classes, strength=1.0, tol=1e-4, max_steps=2000):
    """{class: weights with the intercept last} for rows (label int, indices array<int>, values array<double>).
    All classes share the passes. Rows without values count with the intercept alone; of no rows all weights are 0."""
    walks = {c: _newton(size, strength, tol, max_steps) for c in classes}
    asked, found = {c: next(walk) for c, walk in walks.items()}, {}
    while asked:
        for c, sums in _answer(rows, asked, size).items():
            try:
                asked[c] = walks[c].send(sums)
            except StopIteration as end:
                found[c] = end.value
                del asked[c]
    return found


class SquaredHingeSVM(Estimator, HasFeaturesCol, HasLabelCol):
    """MLlib estimator around `fit_weights`; its model is MLlib's own one-against-rest model and is saved as such.
    Of two classes one is fitted and the other mirrored. Rows with a null label or features take no part."""

    def __init__(self, strength=1.0, tol=1e-4, max_steps=2000):
        super().__init__()
        self.strength, self.tol, self.max_steps = strength, tol, max_steps

    def setLabelCol(self, value):
        return self._set(labelCol=value)

    def _fit(self, dataset):
        # A sparse vector names its features; a dense one has one value for each.
        parts = F.unwrap_udt(self.getFeaturesCol())
        features = F.coalesce(parts["indices"], F.sequence(F.lit(0), F.size(parts["values"]) - 1))
        used = dataset.filter(F.col(self.getLabelCol()).isNotNull() & F.col(self.getFeaturesCol()).isNotNull())
        rows = stored(used.select(F.col(self.getLabelCol()).cast("int").alias("label"), F.when(F.size(parts["values"]) == 0, F.array().cast("array<int>")).otherwise(features).alias("indices"),
                                  parts["values"].alias("values"), F.coalesce(parts["size"], F.size(parts["values"])).alias("size")), "svm-rows")
        n, size = rows.agg(F.max("label") + 1, F.max("size")).head()
        if n is None:
            raise ValueError("no labelled rows to fit")
        n = max(n, 2)
        weights = fit_weights(rows.drop("size"), size, range(1, 2) if n == 2 else range(n), self.strength, self.tol, self.max_steps)
        if n == 2:
            weights[0] = -weights[1]
        sc = dataset.sparkSession.sparkContext
        make = sc._jvm.org.apache.spark.ml.classification.LinearSVCModel
        models = []
        for c in range(n):
            model = LinearSVCModel(make(f"{self.uid}_{c}", _py2java(sc, Vectors.dense(weights[c][:size])), float(weights[c][size])))
            models.append(model.setFeaturesCol(self.getFeaturesCol()))
        return OneVsRest(classifier=LinearSVC(), featuresCol=self.getFeaturesCol())._copyValues(OneVsRestModel(models))
