"""Keyword search by an inverted index.

Documents are dealt to shards of a bounded number, and the index holds one row for each (term, shard): document ids, what
the term adds to each of them, and the largest of these gains. A row is bounded however common its term is. Files are
sorted by term, so a search opens only those of the terms asked for. A query's terms are taken in a shard by falling
bound (MaxScore): once the terms left cannot lift a document to the k-th score, they only complete documents that are
already in. The k-th score is shared: each query starts in the shard with the highest bound, and takes the score found there to the others.
"""
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal import config
from textsignal.functions import text as X
from textsignal.operators.bounds import small_side
from textsignal.operators.ranking import top_k
from textsignal.sources.writers import stored, write_table

SCORE_DIGITS = 9
# Scores are rounded before they are compared, so bounds are compared with this much room.
ROOM = 1e-8
# Tokens that are counted, and ids of posting rows that are weighed, at once.
TOKENS = 500_000
# Stands for all documents in the index; no token is empty.
EVERY = ""
HITS = "query_id long, idx long, score double"
COUNTED = "term string, shard long, ids array<long>, tfs array<int>, lens array<int>"
TERMS = "term string, df long"
BLOCKS = "term string, shard long, n int, top double, ids array<long>, gains array<double>"


def bm25_tokens(c):
    return X.tokenize(F.lower(c), "whitespace")


def bm25_idf(n, df):
    return F.log(n - df + 0.5) - F.log(df + 0.5)


def _lists(values, starts):
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype("int32")), values)


def _starts(*columns):
    """First places of the runs of equal rows."""
    return np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], 0)) + 1])


def _cuts(sizes):
    """Stretches (i, j) of documents with about `TOKENS` tokens, or one document."""
    part = (np.cumsum(sizes) - sizes) // TOKENS
    begin = _starts(part)
    return zip(begin, np.append(begin[1:], len(sizes)))


def _count(batches):
    """Of a batch of documents, for each term and shard the documents with their counts and lengths."""
    for batch in batches:
        if not batch.num_rows:
            continue
        tokens, idx, shard = batch.column("tokens"), batch.column("idx").to_numpy(), batch.column("shard").to_numpy()
        size = np.diff(tokens.offsets.to_numpy())
        coded = tokens.flatten().dictionary_encode()
        words = len(coded.dictionary) + 1
        # Some documents at a time: 4 + 4 + 4 bytes stay of each of their terms, not the arrays that the counts are made with.
        index, ends, found = coded.indices.to_numpy(), np.append(0, np.cumsum(size)), []
        del tokens
        for i, j in _cuts(size):
            at = np.concatenate([np.repeat(np.arange(i, j), size[i:j]) * words + index[ends[i]:ends[j]], np.arange(i, j) * words + words - 1])
            key, tf = np.unique(at, return_counts=True)
            tf[key % words == words - 1] = 0
            found.append([c.astype("int32") for c in (key // words, key % words, tf)])
        row, code, tf = (np.concatenate(c) for c in zip(*found))
        del found, index
        # Rows count up, and with them shards.
        order = np.argsort(code, kind="stable")
        row, code, tf = row[order], code[order], tf[order]
        starts = _starts(code, shard[row])
        terms = pa.concat_arrays([coded.dictionary.cast(pa.string()), pa.array([EVERY])]).take(pa.array(code[starts]))
        yield pa.RecordBatch.from_arrays([terms, pa.array(shard[row[starts]]), *(_lists(pa.array(c), starts) for c in (idx[row], tf.astype("int32"), size[row].astype("int32")))],
                                         names=["term", "shard", "ids", "tfs", "lens"])


def _post(k1, b, avg_len):
    """Rows sorted by term and shard as one row for each, with what the term adds to each document."""
    def packed(rows, starts):
        ids, tf, size = (rows.column(c).flatten() for c in ("ids", "tfs", "lens"))
        tf, size = tf.to_numpy().astype(float), size.to_numpy()
        gain = np.where(tf > 0, tf * (k1 + 1) / (tf + k1 * (1 - b + b * size / avg_len)), 0.0)
        offsets = rows.column("ids").offsets.to_numpy()
        first = (offsets - offsets[0])[starts]
        return pa.RecordBatch.from_arrays(
            [rows.column("term").take(pa.array(starts)), rows.column("shard").take(pa.array(starts)), pa.array(np.diff(np.append(first, len(ids))).astype("int32")),
             pa.array(np.maximum.reduceat(gain, first)), _lists(ids, first), _lists(pa.array(gain), first)], names=["term", "shard", "n", "top", "ids", "gains"])

    def run(batches):
        held = None
        for batch in batches:
            held = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not held.num_rows:
                continue
            starts = _starts(held.column("term").dictionary_encode().indices.to_numpy(), held.column("shard").to_numpy())
            # The last row may go on in the next batch.
            size = np.diff(held.column("ids").offsets.to_numpy())
            rows = np.add.reduceat(size, starts)[:-1]
            for i, j in _cuts(rows) if len(rows) else ():
                yield packed(held.slice(starts[i], starts[j] - starts[i]), starts[i:j] - starts[i])
            held = held.slice(starts[-1])
        if held is not None and held.num_rows:
            yield packed(held, np.zeros(1, "int64"))
    return run


class KeywordIndex:
    """`blocks` by term and shard, `terms` with their document frequency, and the corpus statistics."""

    def __init__(self, blocks, terms, stats):
        self.blocks, self.terms, self.stats = blocks, terms, stats

    @classmethod
    def load(cls, spark, path):
        """An index that `build` has stored under `path`."""
        read = lambda schema, name: spark.read.schema(schema).parquet(os.path.join(path, name))
        return cls(read(BLOCKS, "blocks"), read(TERMS, "terms"), json.loads(read("json string", "stats").head()["json"]))

    @classmethod
    def build(cls, docs, path=None, id_col="idx", text="text", k1=config.BM25_K1, b=config.BM25_B, shard_docs=config.SHARD_DOCS, only=None):
        """Index whole documents. Ids must be unique; documents without text or id are left out. Texts are tokenised once.

        With `path` the whole index is stored there. Without, for a single search, it lies in a scratch folder and may hold
        only the terms of the frame `only` (term); frequencies and statistics are those of all terms in any case.
        """
        spark = docs.sparkSession
        # A shard is a stretch of rows of one task, so a batch of documents belongs to one or two shards and its lists stay long.
        shard = F.floor(F.monotonically_increasing_id() / shard_docs)
        tokens = docs.filter(F.col(text).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("idx"), shard.alias("shard"), bm25_tokens(F.col(text)).alias("tokens"))
        counted = stored(tokens.mapInArrow(_count, COUNTED), "counts")
        total = F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda s, x: s + x))
        n_docs, length, shards = counted.filter(F.col("term") == EVERY).agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)), total, F.count_distinct("shard")).head()
        avg_len = length / n_docs if n_docs else None
        terms = stored(counted.filter(F.col("term") != EVERY).groupBy("term").agg(F.sum(F.size("ids")).alias("df")), "terms")
        mean_idf = terms.agg(F.avg(bm25_idf(F.lit(n_docs), F.col("df")))).head()[0]
        # Few terms go to every task, so that the other counts stay where they are.
        kept = counted if only is None else counted.join(small_side(only.select("term").union(spark.createDataFrame([(EVERY,)], "term string"))), "term", "left_semi")
        # Files sorted by term: a search opens those of its terms. A common term goes over many of them, by shard.
        sort = ["term", "shard"]
        blocks = kept.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInArrow(_post(k1, b, avg_len or 1.0), BLOCKS)
        stats = {"n_docs": n_docs, "avg_len": avg_len, "mean_idf": mean_idf, "shards": shards}
        if path is None:
            return cls(stored(blocks, "blocks"), terms, stats)
        write_table(blocks, os.path.join(path, "blocks"))
        write_table(terms, os.path.join(path, "terms"))
        write_table(spark.createDataFrame([(json.dumps(stats),)], "json string").coalesce(1), os.path.join(path, "stats"))
        return cls.load(spark, path)


class _Shard:
    """Posting rows of one shard, with ids as places in the sorted ids of the shard."""

    def __init__(self, terms, ids, gains):
        # A term's ids differ; the ids of some terms at a time are added to those of the others.
        self.ids = ids[0]
        for i in range(0, len(ids), 64):
            self.ids = np.unique(np.concatenate([self.ids, *ids[i:i + 64]]))
        self.postings = {t: (np.searchsorted(self.ids, i).astype("int32"), g) for t, i, g in zip(terms, ids, gains)}

    def best(self, terms, weights, k, floor):
        """(id, score) of the k best documents at or above `floor`."""
        found = [(t, w, max(0.0, w * self.postings[t][1].max())) for t, w in zip(terms, weights) if t in self.postings]
        found.sort(key=lambda x: -x[2])
        left = np.append(np.cumsum([x[2] for x in found][::-1])[::-1], 0.0)
        score, known = np.zeros(len(self.ids)), np.zeros(len(self.ids), bool)
        for (t, w, _), most in zip(found, left):
            at, gain = self.postings[t]
            if most < floor - ROOM:
                # The terms from here on cannot lift a new document to the floor.
                known &= score + most >= floor - ROOM
                if not known.any():
                    break
                some = known[at]
                score[at[some]] += w * gain[some]
            else:
                score[at] += w * gain
                known[at] = True
        rows = np.flatnonzero(known)
        value = np.round(score[rows], SCORE_DIGITS)
        rows, value = rows[value >= floor - ROOM], value[value >= floor - ROOM]
        order = np.lexsort((self.ids[rows], -value))[:k]
        return self.ids[rows[order]], value[order]


def _search_shard(k):
    """One group: posting rows of a shard, and the terms of the queries that visit it."""
    def run(rows):
        asks = rows.filter(np.asarray(rows.column("query_id").is_valid()))
        posts = rows.filter(np.asarray(rows.column("query_id").is_null()))
        out = []
        if asks.num_rows and posts.num_rows:
            arrays = lambda c: [x.values.to_numpy() for x in posts.column(c)]
            shard = _Shard(posts.column("term").to_pylist(), arrays("ids"), arrays("gains"))
            asked = {}
            for q, t, w, floor in zip(*(asks.column(c).to_pylist() for c in ("query_id", "term", "weight", "floor"))):
                asked.setdefault((q, floor), []).append((t, w))
            for (q, floor), terms in asked.items():
                ids, score = shard.best(*zip(*terms), k, floor)
                out.append((np.full(len(ids), q), ids, score))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)]
        return pa.table([pa.array(c) for c in columns], names=["query_id", "idx", "score"])
    return run


def _visit(index, asked, visits, k, parts):
    """Hits of the given (query_id, shard, floor) visits. The queries of a shard go in parts, each with its own copy of the posting rows."""
    asks = visits.join(asked, "query_id").select("shard", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part"), "term", "query_id", "weight", "floor")
    posts = index.blocks.join(asked.select("term").distinct(), "term", "left_semi").join(visits.select("shard").distinct(), "shard", "left_semi")
    posts = posts.select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "term", "ids", "gains")
    return asks.unionByName(posts, allowMissingColumns=True).groupBy("shard", "part").applyInArrow(_search_shard(k), HITS)


def _asked(queries, text):
    """(query_id, term, qtf); the term is null for a query without words."""
    return queries.select(F.col("query_id").cast("long"), F.explode_outer(bm25_tokens(F.col(text))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def search(queries, index, k=config.TOP_K, text="text", epsilon=config.BM25_EPSILON):
    """(query_id, idx, score, rank) for (query_id, text) queries; exact.

    Documents without any query term score 0 and fill up queries with fewer matches, lowest ids first. Terms found in more than half of
    the documents weigh `epsilon` times the mean idf; where that is negative, matches rank after documents without one.
    """
    spark, stats = queries.sparkSession, index.stats
    if not stats["n_docs"]:
        return spark.createDataFrame([], HITS + ", rank int")
    asked = _asked(queries, text)
    idf = bm25_idf(F.lit(stats["n_docs"]), F.col("df"))
    weight = F.col("qtf") * F.when(idf >= 0, idf).otherwise(F.lit(epsilon * (stats["mean_idf"] or 0.0)))
    asked = stored(asked.join(index.terms, "term", "left").select("query_id", "term", weight.alias("weight")), "asked")
    # With a negative weight a document without a match beats those with one: such queries look at all documents.
    below = asked.filter("weight < 0").select("query_id").distinct()
    others = asked.select("query_id").distinct().join(below, "query_id", "left_anti")
    asked = asked.filter("weight is not null").union(below.select("query_id", F.lit(EVERY).alias("term"), F.lit(0.0).alias("weight")))
    bounds = asked.join(index.blocks.select("term", "shard", "top"), "term").groupBy("query_id", "shard").agg(F.sum(F.greatest(F.col("weight") * F.col("top"), F.lit(0.0))).alias("bound"))
    bounds = stored(bounds, "bounds")
    parts = asked.count() // config.TERM_BLOCK + 1
    homes = bounds.groupBy("query_id").agg(F.max(F.struct("bound", "shard")).alias("home")).select("query_id", F.col("home.shard").alias("shard"))
    hits = first = stored(_visit(index, asked, homes.withColumn("floor", F.lit(float("-inf"))), k, parts), "hits")
    if stats["shards"] > 1:
        floors = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(float("-inf")).alias("floor"))
        rest = bounds.join(homes, ["query_id", "shard"], "left_anti").join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        hits = first.union(stored(_visit(index, asked, rest.filter(F.col("bound") >= F.col("floor") - ROOM).select("query_id", "shard", "floor"), k, parts), "hits"))
    # Fewer than k documents match any other query that needs filling up, so the 2k lowest ids hold enough without a match.
    lowest = [r[0] for r in index.blocks.filter(F.col("term") == EVERY).select(F.explode(F.slice(F.array_sort("ids"), 1, 2 * k)).alias("idx")).orderBy("idx").limit(2 * k).collect()]
    fill = others.select("query_id", F.explode(F.array(*map(F.lit, lowest)).cast("array<long>")).alias("idx")).join(hits, ["query_id", "idx"], "left_anti")
    return top_k(hits.union(fill.withColumn("score", F.lit(0.0))), k)


def bm25_top_k(queries, docs, k=config.TOP_K, id_col="idx", text="text", k1=config.BM25_K1, b=config.BM25_B, epsilon=config.BM25_EPSILON):
    """One search over documents that are indexed for it: only the terms of the queries are posted."""
    return search(queries, KeywordIndex.build(docs, None, id_col, text, k1, b, only=_asked(queries, text).select("term").distinct()), k, text, epsilon)
