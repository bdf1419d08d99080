"""Random forest for rows that are mostly zero, grown level by level.

It makes the choices of MLlib's forest (thresholds from a sample, a Poisson bootstrap, root-of-features subsets, Gini gain, merged leaves) and returns
MLlib's model. MLlib keeps every row with a number for each of its features, and sends one for each bin, sampled feature and open node
from every task. Here rows keep what is not zero, packed, and tasks send the counts that are not zero; what is missing to
the rows of a node lies in the bin of zero. A task unfolds a few hundred rows at once. The driver holds the trees.
"""
import json
import time
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import functions as F

from textsignal.operators.packing import pack, unpack
from textsignal.sources.writers import scratch_dir, stored

# Rows that are unfolded at once, pairs of row and tree looked at together, counts that pile up before they are summed, cells that may be
# summed in an array, open nodes of a pass, and nodes whose splits are weighed at once.
ROWS, PAIRS, PILE, CELLS, OPEN, NODES = 512, 16_384, 2_000_000, 4_000_000, 32_768, 64
# Chances of at most 0, 1, 2, ... copies of a row in a bootstrap sample.
COPIES = np.cumsum(np.exp(-1) / np.cumprod([1, *range(1, 20)]))
TREE = "org.apache.spark.ml.classification.DecisionTreeClassificationModel"
FOREST = "org.apache.spark.ml.classification.RandomForestClassificationModel"


def _uniform(x, seed):
    """Numbers from 0 to 1 for whole numbers, always the same."""
    with np.errstate(over="ignore"):
        h = x.astype("uint64") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed % 2 ** 64)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return (h >> np.uint64(11)) / float(1 << 53)


def _cuts(values, uses, zeros, most):
    """At most `most` thresholds for sorted distinct values and their uses: between all neighbours, or at even steps of uses."""
    if zeros > 0:
        at = np.searchsorted(values, 0.0)
        if at < len(values) and values[at] == 0:
            uses = uses + zeros * (np.arange(len(values)) == at)
        else:
            values, uses = np.insert(values, at, 0.0), np.insert(uses, at, zeros)
    middle = (values[1:] + values[:-1]) / 2
    if len(middle) <= most:
        return middle
    out, step = [], uses.sum() / (most + 1)
    upto, target = np.cumsum(uses).tolist(), step
    for i in range(1, len(upto)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(middle[i - 1])
            target += step
    return np.array(out[:most])


def _thresholds(rows, size, n_rows, most, seed):
    """(size, most) thresholds of the features, filled up with infinity, from about as many rows as MLlib takes for them."""
    share = min(1.0, max((most + 1) ** 2, 10_000) / n_rows)
    sample = rows if share == 1 else rows.filter(F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    n = sample.count()
    each = sample.select(F.inline(F.arrays_zip(F.col("indices").alias("feature"), F.col("values").alias("value")))).toDF("feature", "value")
    counted = each.filter("value <> 0").groupBy("feature", "value").agg(F.count("*").alias("n")).withColumn("_part", F.pmod("feature", F.lit(64)))

    def cut(table):
        table = table.sort_by([("feature", "ascending"), ("value", "ascending")])
        feature, value, uses = (table.column(c).to_numpy() for c in ("feature", "value", "n"))
        first, begin = np.unique(feature, return_index=True)
        found = [_cuts(value[i:j], uses[i:j], n - uses[i:j].sum(), most) for i, j in zip(begin, np.append(begin[1:], len(feature)))]
        return pa.table([pa.array(first, pa.int32()), pa.array(found, pa.list_(pa.float64()))], names=["feature", "cuts"])
    out = np.full((size, most), np.inf)
    for feature, cuts in zip(*counted.groupBy("_part").applyInArrow(cut, "feature int, cuts array<double>").toArrow().to_pydict().values()):
        out[feature, :len(cuts)] = cuts
    return out


def _binned(shared):
    """Task function: rows as packed numbers of their class, and the features that are not in their bin of zero, with one more than the bin."""
    def run(batches):
        cuts = shared.value
        zero = (cuts < 0).sum(1)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                part = batch.slice(begin, ROWS)
                lists = part.column("indices")
                feature, value = lists.flatten().to_numpy(), part.column("values").flatten().to_numpy()
                row = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                bin_ = np.concatenate([np.zeros(0, "int64"), *[(cuts[feature[i:i + PILE // 8]] < value[i:i + PILE // 8, None]).sum(1) for i in range(0, len(value), PILE // 8)]])
                use = bin_ != zero[feature]
                bag = pack(part.column("label").to_numpy(), np.bincount(row[use], minlength=part.num_rows), feature[use], bin_[use] + 1)
                yield pa.RecordBatch.from_arrays([pa.array([part.column("row")[0].as_py()]), pa.array([bag], pa.binary())], names=["first", "bag"])
    return run


def _subsets(n, size, most, draw):
    """`most` different features for each of n nodes."""
    if most >= size:
        return np.tile(np.arange(size, dtype="int32"), (n, 1))
    out = draw.integers(0, size, (n, most), dtype="int32")
    while True:
        order = np.argsort(out, axis=1, kind="stable")
        ranked = np.take_along_axis(out, order, 1)
        again, k = np.nonzero(ranked[:, 1:] == ranked[:, :-1])
        if not len(again):
            return out
        out[again, order[again, k + 1]] = draw.integers(0, size, len(again), dtype="int32")


def _pieces(key, uses, span):
    """Sorted keys and their uses as packed rows (part, cells), a part for each `span` of keys."""
    part = key // span
    begin = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(key) else np.zeros(0, "int64")
    cells = [pack(np.diff(key[i:j] - part[i] * span, prepend=0), uses[i:j]) for i, j in zip(begin, np.append(begin[1:], len(key)))]
    return pa.RecordBatch.from_arrays([pa.array(part[begin], pa.int64()), pa.array(cells, pa.binary())], names=["part", "cells"])


def _count(shared, trees, size, bins, classes, seed, span):
    """Task function: uses of (open node, sampled feature, bin, class) in the rows of the task, without those in the bins of zero.

    Behind the features of a node stand its rows by class.
    """
    def run(batches):
        feature, cut, zero_right, left, slot, subset = shared.value
        most = subset.shape[1]
        n_cells = len(subset) * (most + 1) * bins * classes
        pile, high, summed = [], 0, np.zeros(n_cells, "int64") if n_cells <= CELLS else None

        def flush():
            key = np.concatenate(pile)
            pile.clear()
            if summed is not None:
                summed[:] += np.bincount(key, minlength=n_cells)
                return None
            key.sort()
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            return _pieces(key[begin], np.diff(np.append(begin, len(key))), span)

        for batch in batches:
            for first, bag in zip(batch.column("first").to_pylist(), batch.column("bag")):
                label, lengths, index, code = unpack(bag.as_py())
                n = len(label)
                rows = np.zeros((n, size), "uint8")
                rows[np.repeat(np.arange(n), lengths), index] = code
                flat = rows.ravel()
                copies = np.searchsorted(COPIES, _uniform(np.arange(first * trees, (first + n) * trees), seed), side="right").reshape(n, trees)
                row, node = np.nonzero(copies)
                uses = copies[row, node]
                at = np.arange(len(row))
                while len(at := at[left[node[at]] >= 0]):
                    x = node[at]
                    c = flat[row[at] * size + feature[x]]
                    node[at] = left[x] + np.where(c > 0, c > cut[x] + 1, zero_right[x])
                s = slot[node]
                use = s >= 0
                row, uses, s = row[use], uses[use], s[use]
                for i in range(0, len(s), PAIRS):
                    r, u, node_of = row[i:i + PAIRS], uses[i:i + PAIRS], s[i:i + PAIRS]
                    c = flat[(r * size)[:, None] + subset[node_of]].ravel()
                    hit = np.flatnonzero(c)
                    pair = hit // most
                    base = node_of * (most + 1)
                    key = ((base[pair] + hit - pair * most) * bins + c[hit] - 1) * classes + label[r[pair]]
                    own = (base + most) * bins * classes + label[r]
                    pile += [np.repeat(key, u[pair]), np.repeat(own, u)]
                    high += len(pile[-1]) + len(pile[-2])
                    if high > PILE:
                        high, out = 0, flush()
                        if out is not None:
                            yield out
        if pile and (out := flush()) is not None:
            yield out
        if summed is not None:
            key = np.flatnonzero(summed)
            yield _pieces(key, summed[key], span)
    return run


def _gini(counts, n):
    return 1 - ((counts / np.maximum(n, 1)[..., None]) ** 2).sum(-1)


def _best(shared, zero, bins, classes, span):
    """The best split of every open node of a part: (slot, feature, cut, gain, uses of the left side and of both by class)."""
    def run(table):
        subset = shared.value[-1]
        most = subset.shape[1]
        part = table.column("part")[0].as_py()
        found = [unpack(c.as_py()) for c in table.column("cells")]
        key, uses = np.concatenate([np.cumsum(k) for k, _ in found]), np.concatenate([u for _, u in found])
        order = np.argsort(key, kind="stable")
        key, uses = key[order], uses[order]
        width = (most + 1) * bins * classes
        out = {c: [] for c in ("slot", "feature", "cut", "gain", "left", "all")}
        for begin in range(0, span // width, NODES):
            some = slice(*np.searchsorted(key, [begin * width, (begin + NODES) * width]))
            if some.start == some.stop:
                continue
            cells = np.bincount(key[some] - begin * width, uses[some], NODES * width).reshape(NODES, most + 1, bins, classes)
            every, cells = cells[:, most, 0], cells[:, :most]
            there = np.flatnonzero(every.sum(1))
            every, cells, slot = every[there], cells[there], part * (span // width) + begin + there
            cells[np.arange(len(there))[:, None], np.arange(most), zero[subset[slot]]] += every[:, None] - cells.sum(2)
            low = np.cumsum(cells, 2)[:, :, :-1]
            high = every[:, None, None] - low
            n, n_low, n_high = every.sum(1), low.sum(-1), high.sum(-1)
            gain = _gini(every, n)[:, None, None] - (n_low * _gini(low, n_low) + n_high * _gini(high, n_high)) / n[:, None, None]
            gain = np.where((n_low > 0) & (n_high > 0), gain, -1.0).reshape(len(there), -1)
            best = gain.argmax(1) if gain.shape[1] else np.zeros(len(there), "int64")
            at = np.arange(len(there))
            j, cut = np.divmod(best, max(1, bins - 1))
            out["slot"] += slot.tolist()
            out["feature"] += subset[slot, j].tolist()
            out["cut"] += cut.tolist()
            out["gain"] += gain[at, best].tolist() if gain.shape[1] else [-1.0] * len(there)
            out["left"] += (low[at, j, cut] if gain.shape[1] else every).tolist()
            out["all"] += every.tolist()
        return pa.table([pa.array(out["slot"], pa.int64()), pa.array(out["feature"], pa.int32()), pa.array(out["cut"], pa.int32()), pa.array(out["gain"], pa.float64()),
                         pa.array(out["left"], pa.list_(pa.float64())), pa.array(out["all"], pa.list_(pa.float64()))], names=list(out))
    return run


def grow(rows, size, classes, trees, depth, max_bins, seed):
    """Trees for rows (row long, label int, indices array<int>, values array<double>): arrays by node of its tree, feature, threshold, gain,
    left child (the right one is the next; -1 of leaves) and uses by class. The roots are the first nodes."""
    spark = rows.sparkSession
    n_rows = rows.count()
    cuts = _thresholds(rows, size, n_rows, max(1, min(max_bins, n_rows) - 1), seed)
    bins, zero = cuts.shape[1] + 1, (cuts < 0).sum(1)
    shared = spark.sparkContext.broadcast(cuts)
    bags = stored(rows.mapInArrow(_binned(shared), "first long, bag binary"), "forest-rows")
    shared.unpersist()
    most = size if trees == 1 else int(np.ceil(np.sqrt(size)))
    width = (most + 1) * bins * classes
    together = max(1, min(OPEN, (2 ** 31 - 1) // width))
    draw = np.random.default_rng(seed)
    blank = lambda n, tree: {"tree": np.asarray(tree), "feature": np.full(n, -1, "int32"), "cut": np.full(n, -1, "int16"), "gain": np.full(n, -1.0), "left": np.full(n, -1), "all": np.zeros((n, classes))}
    nodes = blank(trees, np.arange(trees))
    open_ = np.arange(trees)
    for level in range(depth + 1):
        after = []
        for begin in range(0, len(open_), together):
            group = open_[begin:begin + together]
            slot = np.full(len(nodes["left"]), -1)
            slot[group] = np.arange(len(group))
            subset = _subsets(len(group), size, most, draw)
            inner = np.maximum(nodes["feature"], 0)
            shared = spark.sparkContext.broadcast((inner, nodes["cut"], zero[inner] > nodes["cut"], nodes["left"], slot, subset))
            span = width * max(1, -(-len(group) // (4 * spark.sparkContext.defaultParallelism)))
            # Parts weigh splits, which costs more than their few bytes tell, so that they are not gathered in one task.
            cells = bags.mapInArrow(_count(shared, trees, size, bins, classes, seed, span), "part long, cells binary").repartition(spark.sparkContext.defaultParallelism, "part")
            found = cells.groupBy("part").applyInArrow(_best(shared, zero, bins, classes, span), "slot long, feature int, cut int, gain double, left array<double>, all array<double>").toArrow()
            shared.unpersist()
            if not found.num_rows:
                continue
            at = group[found.column("slot").to_numpy()]
            low, every = (np.array(found.column(c).combine_chunks().flatten()).reshape(-1, classes) for c in ("left", "all"))
            gain = found.column("gain").to_numpy()
            nodes["all"][at] = every
            # What rounding leaves of no gain is none.
            split = np.flatnonzero((gain > 1e-12) & (level < depth))
            if not len(split):
                continue
            at, low, every = at[split], low[split], every[split]
            order = np.argsort(at)
            at, low, every, split = at[order], low[order], every[order], split[order]
            child = len(nodes["left"]) + 2 * np.arange(len(at))
            nodes["feature"][at], nodes["cut"][at] = found.column("feature").to_numpy()[split], found.column("cut").to_numpy()[split]
            nodes["gain"][at], nodes["left"][at] = gain[split], child
            new = blank(2 * len(at), np.repeat(nodes["tree"][at], 2))
            new["all"][::2], new["all"][1::2] = low, every - low
            nodes = {c: np.concatenate([nodes[c], new[c]]) for c in nodes}
            if level + 1 < depth:
                mixed = (new["all"] > 0).sum(1) > 1
                after.append(child[0] + np.flatnonzero(mixed))
        open_ = np.concatenate(after) if after else np.zeros(0, "int64")
        if not len(open_):
            break
    nodes["threshold"] = np.where(nodes["left"] >= 0, cuts[np.maximum(nodes["feature"], 0), np.maximum(nodes["cut"], 0)], np.nan)
    return nodes


def merged(nodes):
    """The nodes that are left when two leaves of one class become one, from below, numbered inside their tree; children follow their parents."""
    left, label = nodes["left"].copy(), nodes["all"].argmax(1)
    inner = np.flatnonzero(left >= 0)
    while len(inner):
        a = left[inner]
        same = (left[a] < 0) & (left[a + 1] < 0) & (label[a] == label[a + 1])
        if not same.any():
            break
        # A parent has the class of its merged leaves.
        left[inner[same]] = -1
        inner = inner[~same]
    keep, reached = np.zeros(len(left), bool), np.unique(nodes["tree"], return_index=True)[1]
    while len(reached):
        keep[reached] = True
        inner = reached[left[reached] >= 0]
        reached = np.concatenate([left[inner], left[inner] + 1])
    at = np.flatnonzero(keep)
    at = at[np.lexsort((at, nodes["tree"][at]))]
    tree = nodes["tree"][at]
    number = np.full(len(left), -1)
    number[at] = np.arange(len(at)) - np.searchsorted(tree, tree)
    # Siblings need not be neighbours by number, but both are numbered.
    out = {c: nodes[c][at] for c in ("tree", "feature", "threshold", "gain", "all")}
    below = left[at]
    out |= {"id": number[at], "left": np.where(below >= 0, number[below], -1), "right": np.where(below >= 0, number[np.minimum(below + 1, len(left) - 1)], -1)}
    return out


class SparseForest(RandomForestClassifier):
    """MLlib's classifier with its parameters, its model and its choices, but grown from packed rows. What other parameters ask for is left to MLlib."""

    def _fit(self, dataset):
        usual = {"featureSubsetStrategy": "auto", "impurity": "gini", "subsamplingRate": 1.0, "bootstrap": True, "minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0}
        if any(self.getOrDefault(p) != v for p, v in usual.items()) or self.isDefined("weightCol") or self.getMaxBins() > 250:
            return super()._fit(dataset)
        spark = dataset.sparkSession
        parts = F.unwrap_udt(self.getFeaturesCol())
        there = F.coalesce(parts["indices"], F.when(F.size(parts["values"]) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(parts["values"]) - 1)))
        rows = stored(dataset.select(F.monotonically_increasing_id().alias("row"), F.col(self.getLabelCol()).cast("int").alias("label"), there.alias("indices"), parts["values"].alias("values"),
                                     F.coalesce(parts["size"], F.size(parts["values"])).alias("size")), "forest-input")
        classes, size = rows.agg(F.max("label") + 1, F.max("size")).head()
        if classes is None or not size:
            return super()._fit(dataset)
        classes = max(classes, 2)
        nodes = grow(rows.drop("size"), size, classes, self.getNumTrees(), self.getMaxDepth(), self.getMaxBins(), self.getSeed())
        return self._copyValues(self._model(spark, merged(nodes), size, classes))

    def _model(self, spark, nodes, size, classes):
        """MLlib's model by way of its stored form, since a call for every node would take minutes."""
        path = scratch_dir(spark, "forest")
        said = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {p.name: v for p, v in self._defaultParamMap.items() if p.name != "seed"}}
        params = {p.name: v for p, v in self._paramMap.items()}
        trees = self.getNumTrees()
        whole = said | {"class": FOREST, "uid": self.uid, "paramMap": params, "numFeatures": int(size), "numClasses": int(classes), "numTrees": trees}
        of_tree = ("featuresCol", "labelCol", "predictionCol", "maxDepth", "maxBins", "seed")
        single = lambda: json.dumps(said | {"class": TREE, "uid": f"dtc_{uuid.uuid4().hex[:12]}", "paramMap": {k: v for k, v in params.items() if k in of_tree},
                                            "defaultParamMap": {k: v for k, v in said["defaultParamMap"].items() if k not in ("bootstrap", "featureSubsetStrategy", "numTrees", "subsamplingRate")}})
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame([(t, single(), 1.0) for t in range(trees)], "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        n, leaf = nodes["all"].sum(1), nodes["left"] < 0
        lists = lambda values, lengths: pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(values))
        split = pa.StructArray.from_arrays([pa.array(np.where(leaf, -1, nodes["feature"]), pa.int32()), lists(nodes["threshold"][~leaf], ~leaf), pa.array(np.full(len(n), -1), pa.int32())],
                                           names=["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        data = pa.StructArray.from_arrays([pa.array(nodes["id"], pa.int32()), pa.array(nodes["all"].argmax(1).astype(float)), pa.array(np.where(n > 0, _gini(nodes["all"], n), 0.0)), lists(nodes["all"].ravel(), np.full(len(n), classes)),
                                           pa.array(n.astype("int64")), pa.array(np.where(leaf, -1.0, nodes["gain"])), pa.array(nodes["left"], pa.int32()), pa.array(nodes["right"], pa.int32()), split],
                                          names=["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
        spark.createDataFrame(pa.table([pa.array(nodes["tree"], pa.int32()), data], names=["treeID", "nodeData"])).write.parquet(f"{path}/data")
        return RandomForestClassificationModel.load(path)
