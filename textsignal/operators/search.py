"""Keyword and vector top-k for batches of queries."""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal import config
from textsignal.functions import text as X, vectors as V
from textsignal.operators.bounds import collect_bounded, small_side, unnest
from textsignal.operators.keyword import KeywordIndex, bm25_idf, bm25_tokens, bm25_top_k  # noqa: F401
from textsignal.operators.ranking import top_k
from textsignal.sources.writers import scratch_dir, write_table

SCORE_DIGITS = 9


# ---------------------------------------------------------------- vectors

def _matrix(column):
    """Arrow list column → 2-d double array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _best_of(query, idx, score, k):
    """Cut (query, idx, score) triples to k per query: score down, idx up."""
    order = np.lexsort((idx, -score, query))
    query, idx, score = query[order], idx[order], score[order]
    first = np.r_[True, query[1:] != query[:-1]] if len(query) else np.zeros(0, bool)
    starts = np.maximum.accumulate(np.where(first, np.arange(len(query)), 0)) if len(query) else np.zeros(0, int)
    keep = np.arange(len(query)) - starts < k
    return query[keep], idx[keep], score[keep]


def _block_hits(scores, ids, rows, k):
    """Hits in one block from its query × row scores. A block keeps all scores that tie with its k-th."""
    scores = np.round(scores, SCORE_DIGITS)
    if scores.shape[1] > k:
        floor = np.partition(scores, -k, axis=1)[:, -k][:, None]
        q, v = np.nonzero(scores >= floor)
    else:
        q, v = np.nonzero(np.ones_like(scores, dtype=bool))
    return rows[q], ids[v], scores[q, v]


HITS = "query_id long, idx long, score double"


def _task_top_k(query_ids, blocks, k):
    """Running top k per query over the hits of one task, as a single Arrow batch."""
    best = (np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0))
    for hits in blocks:
        best = _best_of(*[np.concatenate(p) for p in zip(best, hits)], k)
    return pa.RecordBatch.from_arrays([pa.array(query_ids[best[0]]), pa.array(best[1]), pa.array(best[2])],
                                      names=["query_id", "idx", "score"])


def _scan(corpus, query_ids, matrix, k, by_cell=None):
    """Score a batch of queries against every partition and send on k hits per query and task.

    The corpus never moves and no query × vector pairs leave a task. With `by_cell`, a block only
    meets the queries that probe its cell.
    """
    shared = corpus.sparkSession.sparkContext.broadcast((query_ids, matrix, by_cell))
    everyone = np.arange(len(query_ids))

    def run(batches):
        q_ids, q_matrix, cells = shared.value

        def blocks():
            for batch in batches:
                block = _matrix(batch.column("embedding"))
                ids = batch.column("idx").to_numpy(zero_copy_only=False)
                groups = [(everyone, slice(None))]
                if cells is not None:
                    cell = batch.column("cell").to_numpy(zero_copy_only=False)
                    groups = [(cells[c], cell == c) for c in np.unique(cell) if c in cells]
                for rows, part in groups:
                    vectors, numbers = block[part], ids[part]
                    # Slices keep the score matrix at some four million cells.
                    step = max(k, 4_000_000 // max(1, len(q_matrix[rows])))
                    for at in range(0, len(vectors), step):
                        yield _block_hits(q_matrix[rows] @ vectors[at:at + step].T, numbers[at:at + step], rows, k)

        yield _task_top_k(q_ids, blocks(), k)

    columns = ["idx", "embedding"] + (["cell"] if by_cell is not None else [])
    return corpus.select(*columns).mapInArrow(run, HITS), shared


def _blocks(rows, size):
    """A query table as Arrow tables of about `size` rows, read one at a time; no query is split over two."""
    whole = collect_bounded(rows, size)
    if whole is not None:
        yield whole
        return
    # Cut by hash, from a stored copy, so that what made the queries runs once.
    path = scratch_dir(rows.sparkSession, "queries")
    write_table(rows, path)
    rows = rows.sparkSession.read.parquet(path)
    n = 2 * (rows.count() // size + 1)
    for i in range(n):
        yield rows.filter(F.pmod(F.xxhash64("query_id"), F.lit(n)) == i).toArrow()


def _over_blocks(blocks, scan):
    """Hits of all query blocks. A single block stays a lazy plan; of several, each is scored and stored before the
    next one is read, so driver and executors hold one block at a time."""
    found, held = None, None
    for table in blocks:
        if not table.num_rows:
            continue
        if held is not None:
            found = _stored(held, found)
        held = scan(table)
    if found is None:
        return held[0] if held is not None else None
    return _stored(held, found)


def _stored(held, found):
    hits, shared = held
    path = scratch_dir(hits.sparkSession, "hits")
    write_table(hits, path)
    shared.unpersist()
    part = hits.sparkSession.read.schema(HITS).parquet(path)
    return part if found is None else found.unionByName(part)


def _query_blocks(queries):
    """Query vectors in blocks of a checked size, one at a time."""
    return _blocks(queries.select(F.col("query_id").cast("long"), "embedding").filter(F.col("embedding").isNotNull()), config.QUERY_BLOCK)


def vector_table(df, id_col, embedding="embedding", text=None, label="label", source="source"):
    """(idx, embedding, text, label, source): unit-length vectors with what a hit shows."""
    pick = lambda c: F.col(c).cast("string") if c and c in df.columns else F.lit("unknown")
    return (df.filter(F.col(embedding).isNotNull())
            .select(F.col(id_col).cast("long").alias("idx"),
                    V.l2_normalize(F.col(embedding)).cast("array<float>").alias("embedding"),
                    (F.col(text) if text else F.lit(None).cast("string")).alias("text"),
                    pick(label).alias("label"), pick(source).alias("source")))


def save_vector_table(vectors, path, by_cell=False):
    write_table(vectors, path, partition_by="cell" if by_cell else None)


def load_vector_table(spark, path):
    return spark.read.parquet(path)


def dense_top_k(queries, vectors, k=config.TOP_K, label_filter=None, mode="filter_first"):
    """(query_id, idx, score, rank) by inner product; exact.

    A label filter is applied before ranking, so k hits come back when they exist. With
    `mode="overfetch"`, 3k hits are ranked first and filtered after, which may leave fewer. Neither pads.
    """
    if mode not in ("filter_first", "overfetch"):
        raise ValueError(mode)
    early = label_filter is not None and mode == "filter_first"
    corpus = vectors.filter(F.col("label") == label_filter) if early else vectors
    corpus = corpus.filter(F.col("embedding").isNotNull()).withColumn("idx", F.col("idx").cast("long"))
    fetch = k if label_filter is None or early else config.OVERFETCH * k
    found = _over_blocks(_query_blocks(queries), lambda t: _scan(corpus, t.column("query_id").to_numpy(), _matrix(t.column("embedding")), fetch))
    if found is None:
        return queries.sparkSession.createDataFrame([], "query_id long, idx long, score double, rank int")
    hits = top_k(found, fetch)
    if label_filter is not None and not early:
        same = vectors.filter(F.col("label") == label_filter).select("idx")
        hits = top_k(hits.join(same, "idx", "left_semi"), k)
    return hits


def with_metadata(hits, vectors, columns=("text", "label", "source")):
    """Hit rows with the fields of their post. The hit side is k rows per query."""
    return small_side(hits).join(vectors.select("idx", *columns), "idx")


def display(hits):
    """What a hit shows: label, score to 4 places, 200 characters on one line."""
    return hits.select("query_id", "rank", "idx", "label", F.round("score", 4).alias("score"),
                       X.snippet(F.col("text")).alias("snippet"))


def assign_cells(vectors, cells=config.IVF_CELLS, seed=config.SEED, max_iter=20):
    """(vectors with their cell, centres): coarse quantiser from k-means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    data = vectors.withColumn("_v", array_to_vector("embedding"))
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, featuresCol="_v", predictionCol="cell").fit(data)
    return model.transform(data).drop("_v"), np.array(model.clusterCenters())


def ivf_top_k(queries, cell_vectors, centres, k=config.TOP_K, nprobe=config.IVF_PROBES):
    """Approximate top-k: each query meets only the vectors of its `nprobe` nearest cells.

    On a table partitioned by cell the filter below prunes partitions.
    """
    def scan(table):
        ids, matrix = table.column("query_id").to_numpy(), _matrix(table.column("embedding"))
        # Squared distances but for the query's own length, which orders nothing.
        distance = (centres ** 2).sum(1) - 2 * matrix @ centres.T
        probed = np.argsort(distance, axis=1, kind="stable")[:, :nprobe]
        by_cell = {int(c): np.nonzero((probed == c).any(axis=1))[0] for c in np.unique(probed)}
        return _scan(cell_vectors.filter(F.col("cell").isin(sorted(by_cell))), ids, matrix, k, by_cell)

    found = _over_blocks(_query_blocks(queries), scan)
    if found is None:
        return queries.sparkSession.createDataFrame([], "query_id long, idx long, score double, rank int")
    return top_k(found, k)


def recall(approximate, exact, k=config.TOP_K):
    """Share of the exact top-k that the approximate search found."""
    both = exact.join(approximate.select("query_id", "idx"), ["query_id", "idx"], "left_semi")
    return both.agg(F.count("*").alias("found")).select(
        (F.col("found") / exact.agg(F.count("*").alias("n")).scalar()).alias("recall"))


# ---------------------------------------------------------------- keywords

def document_frequencies(docs, text="text"):
    """(term, df) over the whole vocabulary. The distinct tokens of a document are found inside its row."""
    tokens = docs.select(F.array_distinct(bm25_tokens(F.col(text))).alias("_d"))
    return unnest(tokens, [], "_d", "term").groupBy("term").agg(F.count("*").alias("df"))


def bm25_statistics(docs, text="text"):
    """One row: n_docs, avg_len and the mean idf over the whole vocabulary, the base of the floor for terms
    found in more than half of the documents."""
    vocabulary = document_frequencies(docs, text)
    shape = docs.select(F.size(bm25_tokens(F.col(text))).alias("len")).agg(
        F.count("*").alias("n_docs"), F.avg("len").alias("avg_len"))
    n = shape.select("n_docs").scalar()
    return shape.withColumn("mean_idf", vocabulary.agg(F.avg(bm25_idf(n, F.col("df"))).alias("m")).scalar())


def compare(dense, keyword):
    """Ranks and scores of both searches side by side; a hit of only one side has nulls for the other."""
    d = dense.select("query_id", "idx", F.col("rank").alias("dense_rank"), F.col("score").alias("dense_score"))
    b = keyword.select("query_id", "idx", F.col("rank").alias("bm25_rank"), F.col("score").alias("bm25_score"))
    return d.join(b, ["query_id", "idx"], "full_outer")
