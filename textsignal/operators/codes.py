"""Approximate vector search over short codes: a two-level quantiser, product-quantised residuals, and an exact second look.

Every vector belongs to a cell (a coarse centre, then one of the finer centres under it; the number of cells grows with
the rows) and is stored as one byte for each group of components: the nearest entry of that group's codebook to what the
vector differs from its cell's centre. A search reads the codes of the nearest cells, keeps a short list for each query, and
fetches the full vectors of the short list only.
"""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal import config
from textsignal.functions import vectors as V
from textsignal.operators import search as SE
from textsignal.operators.ranking import top_k
from textsignal.sources.writers import stored


def _nearest(rows, centres):
    """Nearest centre of each row, in slices that bound the distance matrix."""
    length = (centres ** 2).sum(1)
    step = max(1, 4_000_000 // max(1, len(centres)))
    return np.concatenate([(length - 2 * rows[i:i + step] @ centres.T).argmin(1) for i in range(0, len(rows), step)] or [np.zeros(0, "int64")])


def _k_means(rows, k, rounds=12, seed=config.SEED):
    """Centres of a sample that fits in memory; an empty one takes the row farthest from its own centre."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(rounds if k < len(rows) else 0):
        near = _nearest(rows, centres)
        size = np.bincount(near, minlength=len(centres))
        far = np.argsort(-((rows - centres[near]) ** 2).sum(1), kind="stable")
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
        empty = np.flatnonzero(size == 0)
        centres[empty] = rows[far[:len(empty)]]
    return centres


class Quantiser:
    """Coarse centres, the cells under them, and a codebook for each group of components. Fitted on a bounded sample."""

    def __init__(self, sample, cells, groups):
        tops = max(1, round(cells ** 0.5))
        self.coarse = _k_means(sample, min(tops, len(sample)))
        near = _nearest(sample, self.coarse)
        under = []
        for t in range(len(self.coarse)):
            part = sample[near == t]
            under.append(_k_means(part, min(len(part), max(1, round(cells * len(part) / len(sample))))) if len(part) else self.coarse[t:t + 1])
        self.first = np.cumsum([0] + [len(u) for u in under])
        self.centres = np.concatenate(under)
        self.edges = np.arange(groups + 1) * sample.shape[1] // groups
        left = sample - self.centres[self.cell(sample)]
        self.books = [_k_means(left[:, a:b], min(256, len(left))) for a, b in zip(self.edges, self.edges[1:])]

    def cell(self, rows):
        top = _nearest(rows, self.coarse)
        out = np.zeros(len(rows), "int64")
        for t in np.unique(top):
            at = np.flatnonzero(top == t)
            out[at] = self.first[t] + _nearest(rows[at], self.centres[self.first[t]:self.first[t + 1]])
        return out

    def encode(self, rows):
        """(cell, codes) of each row."""
        cell = self.cell(rows)
        left = rows - self.centres[cell]
        return cell, np.stack([_nearest(left[:, a:b], book) for a, b, book in zip(self.edges, self.edges[1:], self.books)], 1).astype("uint8")

    def decode(self, cell, codes):
        return self.centres[cell] + np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], 1)


class CodeIndex:
    """`codes` (idx, cell, label, code) of all vectors, the vectors themselves, and the quantiser."""

    def __init__(self, codes, vectors, quantiser):
        self.codes, self.vectors, self.quantiser = codes, vectors, quantiser

    @classmethod
    def build(cls, vectors, groups=config.CODE_GROUPS, sample_rows=config.CODE_SAMPLE):
        """Index a vector table (idx, embedding, label). Rows without a vector are left out; all vectors have one length.

        The quantiser is fitted on about `sample_rows` rows at most, taken by hash. There are as many cells as the square root of the
        rows, up to a sixteenth of the sample.
        """
        rows = vectors.filter(F.col("embedding").isNotNull()).select(F.col("idx").cast("long").alias("idx"), "embedding", "label")
        n = rows.count()
        sample = rows.filter(F.pmod(F.xxhash64("idx"), F.lit(n // sample_rows + 1)) == 0).limit(2 * sample_rows).select("embedding").toArrow()
        if not sample.num_rows:
            return cls(None, rows, None)
        quantiser = Quantiser(SE._matrix(sample.column("embedding")), min(max(1, round(n ** 0.5)), max(1, sample.num_rows // 16)), groups)
        shared = rows.sparkSession.sparkContext.broadcast(quantiser)

        def encode(batches):
            for batch in batches:
                if batch.num_rows:
                    cell, codes = shared.value.encode(SE._matrix(batch.column("embedding")))
                    yield pa.RecordBatch.from_arrays([batch.column("idx"), pa.array(cell.astype("int32")), batch.column("label"), pa.array([c.tobytes() for c in codes], pa.binary())],
                                                     names=["idx", "cell", "label", "code"])

        coded = rows.mapInArrow(encode, "idx long, cell int, label string, code binary")
        # Files sorted by cell, so that a search skips those without a cell it asks for; a large cell goes over several.
        return cls(stored(coded.repartitionByRange("cell", "idx").sortWithinPartitions("cell", "idx"), "codes"), rows, quantiser)

    def short_list(self, queries, size, probes):
        """(query_id, idx, score, rank): the best `size` rows of each query by the scores of the codes in its nearest cells."""
        quantiser = self.quantiser

        def scan(table):
            ids, matrix = table.column("query_id").to_numpy(), SE._matrix(table.column("embedding"))
            distance = (quantiser.centres ** 2).sum(1) - 2 * matrix @ quantiser.centres.T
            probed = np.argsort(distance, axis=1, kind="stable")[:, :probes]
            asked = np.zeros(distance.shape, bool)
            np.put_along_axis(asked, probed, True, 1)
            shared = queries.sparkSession.sparkContext.broadcast((ids, matrix, asked, quantiser))

            def run(batches):
                q_ids, q, asks, coder = shared.value

                def blocks():
                    for batch in batches:
                        cell = batch.column("cell").to_numpy()
                        codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), "uint8").reshape(len(cell), -1)
                        numbers = batch.column("idx").to_numpy()
                        for c in np.unique(cell):
                            some = np.flatnonzero(asks[:, c])
                            at = np.flatnonzero(cell == c)
                            step = max(size, 4_000_000 // max(1, len(some)))
                            for begin in range(0, len(at) if len(some) else 0, step):
                                part = at[begin:begin + step]
                                yield SE._block_hits(q[some] @ coder.decode(cell[part], codes[part]).T, numbers[part], some, size)

                yield SE._task_top_k(q_ids, blocks(), size)

            cells = np.flatnonzero(asked.any(0)).tolist()
            return self.codes.filter(F.col("cell").isin(cells)).select("idx", "cell", "code").mapInArrow(run, SE.HITS), shared

        found = SE._over_blocks(SE._query_blocks(queries), scan)
        return None if found is None else top_k(found, size)

    def search(self, queries, k=config.TOP_K, probes=None, short=None):
        """(query_id, idx, score, rank) for (query_id, embedding) queries: the k best of a short list, by exact inner products.

        The codes of `probes` cells (by default the share CODE_PROBES of them) and `short` full vectors (by default CODE_SHORT * k) are read for each query.
        """
        found = None
        if self.quantiser is not None:
            found = self.short_list(queries, short or config.CODE_SHORT * k, probes or int(np.ceil(config.CODE_PROBES * len(self.quantiser.centres))))
        if found is None:
            return queries.sparkSession.createDataFrame([], "query_id long, idx long, score double, rank int")
        asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").alias("asked"))
        pairs = stored(found.select("query_id", "idx"), "short").join(self.vectors.select("idx", "embedding"), "idx").join(asked, "query_id")
        return top_k(pairs.select("query_id", "idx", F.round(V.dot(F.col("asked"), F.col("embedding")), SE.SCORE_DIGITS).alias("score")), k)
