"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards by the nearest of a few pivots, which are fitted on a bounded sample; large shards are
cut by hash, so no shard grows with the data. A shard's tree is walked best bound first: the inner product with a
ball's centre plus the query's length times the radius bounds every member, and a node that cannot reach the
current k-th score is left out. The k-th score is shared: a first round searches each query's best shard, and the
second one takes that score into every other shard that can still beat it.
"""
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal.llm.common import written

# Rows that pivots are fitted on, rows of a shard, rows of a leaf, queries that meet a shard at a time, balls that
# meet the queries at a time.
PIVOT_ROWS = 2_000
PIVOTS = 16
SHARD_ROWS = 4_096
LEAF_ROWS = 64
QUERY_BLOCK = 512
BALLS = 256
SCALE = 256


def scaled(vectors, vec_id="vec_id", embedding="embedding"):
    """(vec_id, v array<double>): floor(256 x) of each component. Vectors that are null, empty, without an id, or hold null or non-finite components take no part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter("vec_id is not null and size(v) > 0").filter(finite).select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))


def _matrix(column):
    width = len(column[0].as_py()) if len(column) else 0
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), width)


class BallTree:
    """Nodes (centre, radius, rows or children), split at the median along the widest direction."""

    def __init__(self, points):
        self.points, self.nodes = points, []
        self._grow(np.arange(len(points)))
        self.centres = np.array([n[0] for n in self.nodes])
        self.radii = np.array([n[1] for n in self.nodes])

    def _grow(self, rows):
        part = self.points[rows]
        centre = part.mean(0)
        distance = np.sqrt(((part - centre) ** 2).sum(1))
        at = len(self.nodes)
        self.nodes.append([centre, float(distance.max()), rows, None])
        if len(rows) > LEAF_ROWS and distance.max() > 0:
            far = part[distance.argmax()]
            other = part[((part - far) ** 2).sum(1).argmax()]
            order = np.argsort(part @ (far - other), kind="stable")
            left, right = rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]
            self.nodes[at][3] = (self._grow(left), self._grow(right))
        return at

    def search(self, query, k, floor, ids, skip):
        """The k best (score, -id) at or above `floor`, without the rows whose id is `skip`."""
        bounds = self.centres @ query + self.radii * np.sqrt(query @ query)
        bounds += np.abs(bounds) * 1e-9 + 1e-6
        best, waiting = [], [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < (max(best[0][0], floor) if len(best) == k else floor):
                break
            children = self.nodes[node][3]
            if children:
                for child in children:
                    heapq.heappush(waiting, (-bounds[child], child))
                continue
            rows = self.nodes[node][2]
            rows = rows[ids[rows] != skip]
            scores = self.points[rows] @ query
            order = np.lexsort((ids[rows], -scores))[:k]
            for score, i in zip(scores[order].tolist(), ids[rows[order]].tolist()):
                if score >= floor:
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))
                    else:
                        break
        return best


HITS = "query_id long, score double, vec_id long"


def _search(k):
    """One group: the rows of a shard and the queries that meet it."""
    def run(rows):
        queries = rows.filter(np.asarray(rows.column("floor").is_valid()))
        points = rows.filter(np.asarray(rows.column("floor").is_null()))
        out = []
        if queries.num_rows and points.num_rows:
            # Inner products are sums of whole numbers: exact as doubles while they stay below 2^53.
            matrix, asked = _matrix(points.column("v").combine_chunks()), _matrix(queries.column("v").combine_chunks())
            ids, tree = points.column("vec_id").to_numpy(), BallTree(matrix)
            for q, i, floor in zip(asked, queries.column("vec_id").to_pylist(), queries.column("floor").to_pylist()):
                out += [(i, s, -j) for s, j in tree.search(q, k, floor, ids, i)]
        return pa.table({n: pa.array([o[c] for o in out], t) for c, (n, t) in enumerate(
            (("query_id", pa.int64()), ("score", pa.float64()), ("vec_id", pa.int64())))})
    return run


def _pivots(points):
    """Pivots per dimension from a bounded sample in hash order, by a few rounds of k-means; a driver table of PIVOTS rows each."""
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_ROWS).toPandas()
    pivots = {}
    for size, part in sample.groupby(sample.v.map(len)):
        rows = np.stack(part.v.to_numpy())
        centres = np.unique(rows, axis=0)[:PIVOTS]
        for _ in range(5):
            near = ((rows[:, None] - centres[None]) ** 2).sum(2).argmin(1)
            centres = np.stack([rows[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        pivots[size] = centres
    return pivots


def _assign(pivots):
    def run(batches):
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("v").to_pylist()])
            cell = np.zeros(len(sizes), "int64")
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                if size in pivots:
                    part = _matrix(batch.column("v").take(pa.array(rows)))
                    cell[rows] = ((pivots[size] ** 2).sum(1) - 2 * part @ pivots[size].T).argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(sizes.astype("int64") << 32 | cell)], names=["vec_id", "v", "cell"])
    return run


def top_k(points, queries, k=5):
    """(query_id, rank, vec_id, score long): the k best of all other rows for each query, ties to the smaller id.

    points, queries: (vec_id, v array<double>) of whole numbers as `scaled` gives them. Only rows of equal length
    are compared. A query with fewer than k other rows gets what there is. Rows with the query's id count as the query itself.
    Repeated rows are candidates each for itself; equal query rows ask once, and of different vectors with one id the k best
    hits of all are returned. Empty tables give none. Scores beyond 2^53 are not exact.
    """
    queries = written(queries.dropDuplicates(["vec_id", "v"]), "queries")
    placed = written(points.mapInArrow(_assign(_pivots(points)), "vec_id long, v array<double>, cell long"), "cells")
    sizes = written(placed.groupBy("cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("cuts")), "sizes")
    shards = placed.join(sizes, "cell").select("vec_id", "v", F.concat_ws("-", "cell", F.pmod(F.xxhash64("vec_id"), F.col("cuts"))).alias("shard"))
    shards = written(shards, "shards")
    # A ball around each shard: mean and radius, by component.
    parts = shards.select("shard", F.size("v").alias("size"), F.posexplode("v").alias("i", "x"))
    means = parts.groupBy("shard", "size", "i").agg(F.avg("x").alias("x"))
    means = means.groupBy("shard", "size").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("centre"))
    squared = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
    balls = shards.join(written(means, "means"), "shard").groupBy("shard", "size").agg(
        F.first("centre").alias("centre"), F.sqrt(F.max(squared("v", "centre"))).alias("radius"))
    balls = written(balls, "balls")
    dot = F.aggregate(F.zip_with("v", "centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    # Every query against every shard's ball (not its rows): the bound decides which shards it visits.
    # Balls are dealt to parts of about BALLS, so that no part of this product grows with the data on both sides.
    deals = balls.count() // BALLS + 1
    dealt = balls.withColumn("part", F.pmod(F.xxhash64("shard"), F.lit(deals)))
    spread = queries.select("vec_id", "v", F.size("v").alias("size"), F.explode(F.sequence(F.lit(0), F.lit(deals - 1)).cast("array<long>")).alias("part"))
    bounds = spread.join(dealt, ["part", "size"]).select("vec_id", "shard", (dot + length * F.col("radius")).alias("bound"))
    bounds = written(bounds.groupBy("vec_id", "shard").agg(F.max("bound").alias("bound")).withColumn("bound", F.col("bound") + F.abs("bound") * 1e-9 + 1e-6), "bounds")
    best = bounds.groupBy("vec_id").agg(F.max_by("shard", F.struct("bound", "shard")).alias("home"))
    first = bounds.join(written(best, "homes"), "vec_id").withColumn("floor", F.lit(float("-inf")))

    def searched(asked, name):
        # A shard meets its queries in blocks, each with a copy of the shard's rows, so a group stays bounded.
        counts = written(asked.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks")), "blocks")
        asked = asked.join(counts, "shard").join(queries, "vec_id").select("shard", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"), "vec_id", "v", "floor")
        rows = shards.join(counts, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "vec_id", "v",
                                                   F.lit(None).cast("double").alias("floor"))
        return written(asked.union(rows).groupBy("shard", "block").applyInArrow(_search(k), HITS), name)

    hits = searched(first.filter("shard = home").select("shard", "vec_id", "floor"), "first")
    floors = hits.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).alias("kth"))
    second = first.filter("shard <> home").join(written(floors, "floors"), "vec_id", "left").withColumn("floor", F.coalesce("kth", "floor"))
    hits = hits.union(searched(second.filter("bound >= floor").select("shard", "vec_id", "floor"), "second"))
    from pyspark.sql import Window
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.col("score").cast("long").alias("score")))
