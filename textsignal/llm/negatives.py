"""Hard negatives for anchors, by segment summaries of the vectors.

A vector is cut into segments; each segment's mean and deviation (the length of what is left without the mean) are stored
beside it. In a segment of w components an inner product is w times the product of the means, plus or minus at most the
product of the deviations, so the sums over the segments bound a score from both sides. Bounds of a few wide segments come
first, those of finer ones only for rows and anchors with a pair left, and exact scores last. Anchors are read in
blocks of a fixed size; each block meets every row where it lies, and a task sends on a few rows for each anchor.
"""
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window, functions as F

from textsignal.llm.common import written

# Segments of the finest summaries; each level before it joins two neighbours.
SEGMENTS = 16
LEVELS = (2, 4, 8, 16)
# Anchors that meet the rows at a time, and pairs that a task scores at a time.
ANCHOR_BLOCK = 2_048
PAIRS = 1_000_000


def edges(size, segments):
    return np.arange(segments + 1) * size // segments


def summarise(matrix, segments=SEGMENTS):
    """(means, deviations) of the segments of each row; a segment without components has 0 and 0."""
    cut = edges(matrix.shape[1], segments)
    means, deviations = np.zeros((2, len(matrix), segments))
    for i, (a, b) in enumerate(zip(cut, cut[1:])):
        if b > a:
            means[:, i] = matrix[:, a:b].mean(1)
            deviations[:, i] = np.sqrt(((matrix[:, a:b] - means[:, i, None]) ** 2).sum(1))
    return means, deviations


def levels(means, deviations, size):
    """Summaries of every level from the finest: (weighted means, deviations) so that products of two rows bound their score."""
    out = {}
    segments = means.shape[1]
    while True:
        width = np.diff(edges(size, segments)).astype(float)
        out[segments] = (means * np.sqrt(width), deviations)
        if segments == LEVELS[0]:
            return out
        pair = width.reshape(-1, 2)
        total = np.maximum(pair.sum(1), 1)
        m = means.reshape(len(means), -1, 2)
        joined = (m * pair).sum(2) / total
        deviations = np.sqrt((deviations.reshape(m.shape) ** 2 + pair * (m - joined[:, :, None]) ** 2).sum(2))
        means, segments = joined, segments // 2


def bounds(rows, anchors, level):
    """Lower and upper bounds of the scores of all given rows with all given anchors."""
    (m, d), (am, ad) = rows[level], anchors[level]
    middle, spread = m @ am.T, d @ ad.T
    spread += (np.abs(middle) + spread) * 1e-9 + 1e-6
    return middle - spread, middle + spread


def _matrix(column, size):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _summaries(batches):
    for batch in batches:
        size = np.diff(batch.column("v").offsets.to_numpy())
        means, deviations = np.zeros((2, batch.num_rows, SEGMENTS))
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            means[at], deviations[at] = summarise(_matrix(batch.column("v").take(pa.array(at)), s))
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * SEGMENTS, pa.int32()), pa.array(x.ravel())) for x in (means, deviations)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "v")), *lists], names=["vec_id", "label", "v", "means", "deviations"])


SUMMARIES = "vec_id long, label string, v array<double>, means array<double>, deviations array<double>"


def whole_numbers(vectors, scale=256, vec_id="vec_id", embedding="embedding", label="label"):
    """(vec_id, label, v array<double>): floor(scale x) of each component. Rows without id or label, and vectors that are null, empty, or hold null or non-finite components take no part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter("vec_id is not null and label is not null and size(v) > 0").filter(finite)
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))


def _best(group, score, ident, k):
    """Places of the k best of each group: higher score, then smaller id."""
    order = np.lexsort((ident, -score, group))
    group = group[order]
    first = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    begin = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0)) if len(group) else np.zeros(0, "int64")
    return order[np.arange(len(group)) - begin < k]


class Anchors:
    """One block of anchors of one vector length with the score windows that each of them searches."""

    def __init__(self, table, size, low, high, same_label):
        self.size, self.same = size, same_label
        self.matrix = _matrix(table.column("v").combine_chunks(), size)
        self.levels = levels(*(_matrix(table.column(c).combine_chunks(), SEGMENTS) for c in ("means", "deviations")), size)
        self.ids = table.column("vec_id").to_numpy()
        self.labels = table.column("label").combine_chunks()
        self.low, self.high = low, high
        self.found = (np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0, "int64"))
        self.floor = low.copy()

    def meet(self, batch, at, k):
        """Take the rows `at` of a batch into the k best of each anchor's windows."""
        rows = batch.take(pa.array(at))
        known = pc.unique(self.labels)
        code, own = (pc.fill_null(pc.index_in(c, known), -1).to_numpy(zero_copy_only=False) for c in (rows.column("label"), self.labels))
        matrix, ids = _matrix(rows.column("v"), self.size), rows.column("vec_id").to_numpy()
        summary = levels(*(_matrix(rows.column(c), SEGMENTS) for c in ("means", "deviations")), self.size)
        alive = ((code[:, None] == own) == self.same) & (ids[:, None] != self.ids)
        lowest, highest = self.floor.min(1), self.high.max(1)
        r, a = np.arange(len(ids)), np.arange(len(self.ids))
        for level in LEVELS:
            keep_r, keep_a = alive.any(1), alive.any(0)
            r, a, alive = r[keep_r], a[keep_a], alive[keep_r][:, keep_a]
            if not alive.size:
                return
            under, over = bounds({level: tuple(x[r] for x in summary[level])}, {level: tuple(x[a] for x in self.levels[level])}, level)
            alive &= (over >= lowest[a]) & (under <= highest[a])
        # Whole numbers: exact as doubles while they stay below 2^53.
        scores = matrix[r] @ self.matrix[a].T
        width = self.low.shape[1]
        new = [self.found]
        for j in range(width):
            x, y = np.nonzero(alive & (scores >= self.floor[a, j]) & (scores <= self.high[a, j]))
            new.append((a[y] * width + j, scores[x, y].astype("int64"), ids[r[x]]))
        group, score, ident = (np.concatenate(p) for p in zip(*new))
        best = _best(group, score, ident, k)
        self.found = group, score, ident = group[best], score[best], ident[best]
        # A window that is full admits nothing below its k-th score.
        places, count = np.unique(group, return_counts=True)
        last = np.cumsum(count) - 1
        full = places[count == k]
        self.floor[full // width, full % width] = np.maximum(self.floor[full // width, full % width], score[last[count == k]])


HITS = "anchor long, window int, score long, vec_id long"


def _scan(summaries, table, windows, k, same_label):
    """The k best rows of each task for each anchor and window. windows: (low, high) as matrices, anchors by windows."""
    shared = summaries.sparkSession.sparkContext.broadcast((table, *windows))
    step = max(1, PAIRS // max(1, table.num_rows))

    def run(batches):
        asked, low, high = shared.value
        keys = asked.column("anchor").to_numpy()
        sizes = pc.list_value_length(asked.column("v")).to_numpy()
        blocks = {}
        for s in np.unique(sizes):
            at = np.flatnonzero(sizes == s)
            blocks[s] = (keys[at], Anchors(asked.take(pa.array(at)), s, low[at], high[at], same_label))
        for batch in batches:
            length = np.diff(batch.column("v").offsets.to_numpy())
            for s, (_, anchors) in blocks.items():
                at = np.flatnonzero(length == s)
                for begin in range(0, len(at), step):
                    anchors.meet(batch, at[begin:begin + step], k)
        for s, (key, anchors) in blocks.items():
            group, score, ident = anchors.found
            width = low.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(key[group // width]), pa.array((group % width).astype("int32")), pa.array(score), pa.array(ident)],
                                             names=["anchor", "window", "score", "vec_id"])

    return summaries.mapInArrow(run, HITS), shared


def _blocks(anchors, size):
    """Anchors as Arrow tables of about `size` rows at most, read one at a time."""
    n = anchors.count() // size + 1
    for i in range(n):
        table = (anchors if n == 1 else anchors.filter(F.pmod(F.xxhash64("anchor"), F.lit(n)) == i)).toArrow()
        if table.num_rows:
            yield table


def _search(summaries, anchors, windows, k, same_label, name):
    """(anchor, window, score, vec_id): the k best of each anchor and window over all rows."""
    hits = None
    for table in _blocks(anchors, ANCHOR_BLOCK):
        scan, shared = _scan(summaries, table, windows(table), k, same_label)
        part = written(scan, name)
        shared.unpersist()
        hits = part if hits is None else hits.union(part)
    if hits is None:
        hits = summaries.sparkSession.createDataFrame([], HITS)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(points, is_anchor, positives=5, negatives=5, low=80, high=100):
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, label, v) as `whole_numbers` gives them.

    An anchor's positives are the best other rows of its label. For each of them its negatives are the best rows of other labels
    with low * positive_score <= 100 * negative_score <= high * positive_score; ties go to the smaller id. Rows with the
    anchor's id count as the anchor itself. Repeated rows are rows of their own as positives and negatives; equal anchors ask
    once, and rows that share an id but not label and vector ask each for itself. Only vectors of equal length are
    compared. Scores beyond 2^53 are not exact. Tables without anchors or rows give none.
    """
    summaries = written(points.select("vec_id", F.col("label").cast("string").alias("label"), "v").mapInArrow(_summaries, SUMMARIES), "summaries")
    key = F.xxhash64("vec_id", "label", "v").alias("anchor")
    anchors = written(summaries.filter(is_anchor).select(key, "*").dropDuplicates(["vec_id", "label", "v"]), "anchors")
    everything = lambda t: tuple(np.full((t.num_rows, 1), x) for x in (-np.inf, np.inf))
    near = _search(summaries, anchors, everything, positives, True, "positives")
    ranked = F.array_sort(F.collect_list(F.struct("rank", F.col("vec_id").alias("id"), F.col("score").cast("double").alias("score"))))
    near = near.groupBy("anchor").agg(ranked.alias("near"))
    asked = written(anchors.join(near, "anchor"), "asked")

    def windows(table):
        least, most = np.full((table.num_rows, positives), np.inf), np.full((table.num_rows, positives), -np.inf)
        for i, found in enumerate(table.column("near").to_pylist()):
            for j, p in enumerate(found):
                # The least and greatest whole numbers that keep the two inequalities.
                least[i, j] = -(-low * int(p["score"]) // 100)
                most[i, j] = high * int(p["score"]) // 100
        return least, most

    far = _search(summaries, asked, windows, negatives, False, "negatives")
    of = asked.select("anchor", F.col("vec_id").alias("anchor_id"), F.posexplode("near").alias("window", "positive"))
    return far.join(of, ["anchor", "window"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("positive.score").cast("long").alias("positive_score"), F.col("score").alias("negative_score"))
