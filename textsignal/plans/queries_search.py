"""Registered queries: vector and keyword retrieval."""
from pyspark.sql import functions as F

from textsignal import config
from textsignal.functions import vectors as V
from textsignal.operators import codes as C, search as SE
from textsignal.plans import sql as S
from textsignal.plans.inputs import longs, table
from textsignal.sources import writers

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return register


def vectors(spark, d):
    """The embeddings as a vector table; the text of a vector is the document with its id."""
    emb = table(spark, d, "embeddings")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text", "source")
    return SE.vector_table(emb.join(docs, "vec_id", "left"), "vec_id", text="text")


def bare_vectors(spark, d):
    return SE.vector_table(table(spark, d, "embeddings"), "vec_id")


def prototypes(spark, d):
    """One query per label: the mean of its vectors."""
    parts = table(spark, d, "embeddings").select("label", F.posexplode_outer("embedding").alias("i", "x"))
    mean = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    items = F.array_sort(F.collect_list(F.struct("i", "x")))
    return (mean.groupBy("label").agg(F.transform(items, lambda s: s["x"]).alias("embedding"))
            .select(F.col("label").cast("long").alias("query_id"), V.l2_normalize(F.col("embedding")).alias("embedding")))


# The stored vectors are unit length to float precision; both sides divide by the norm and store floats.
NORM = "list_transform({v}, lambda x: x::DOUBLE / sqrt(list_inner_product({v}::DOUBLE[], {v}::DOUBLE[])))"
CORPUS = f"corpus AS (SELECT vec_id AS idx, {NORM.format(v='embedding')}::FLOAT[]::DOUBLE[] AS v, label::VARCHAR AS label FROM embeddings)"
PROTO = f"""mean AS (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL),
pq AS (SELECT label::BIGINT AS query_id, list(x ORDER BY i) AS v FROM mean GROUP BY label),
qs AS (SELECT query_id, {NORM.format(v='v')} AS v FROM pq)"""
SCORED = "sc AS (SELECT query_id, idx, corpus.label, round(list_inner_product(qs.v, corpus.v), 9) AS score FROM qs CROSS JOIN corpus)"
RANK = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, idx)"


def _shown(hits):
    return longs(hits.select("query_id", "idx", "rank", F.round("score", 6).alias("score")))


@query(f"WITH {CORPUS} SELECT idx, label, round(list_sum(v), 5) AS total, round(list_inner_product(v, v), 5) AS norm FROM corpus")
def l2_normalise(spark, d):
    v = F.col("embedding")
    total = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return bare_vectors(spark, d).select("idx", "label", F.round(total, 5).alias("total"), F.round(V.dot(v, v), 5).alias("norm"))


@query(f"WITH {CORPUS}, {PROTO}, {SCORED}, r AS (SELECT *, {RANK} AS rank FROM sc) SELECT query_id, idx, rank, round(score, 6) AS score FROM r WHERE rank <= 10")
def dense_topk(spark, d):
    return _shown(SE.dense_top_k(prototypes(spark, d), bare_vectors(spark, d)))


@query(f"WITH {CORPUS}, {PROTO}, {SCORED}, r AS (SELECT *, {RANK} AS rank FROM sc WHERE label = '3') SELECT query_id, idx, rank, round(score, 6) AS score FROM r WHERE rank <= 10")
def dense_topk_filtered(spark, d):
    return _shown(SE.dense_top_k(prototypes(spark, d), bare_vectors(spark, d), label_filter="3"))


@query(f"""WITH {CORPUS}, {PROTO}, {SCORED}, r AS (SELECT *, {RANK} AS wide FROM sc),
k AS (SELECT *, {RANK} AS rank FROM r WHERE wide <= 30 AND label = '3') SELECT query_id, idx, rank, round(score, 6) AS score FROM k WHERE rank <= 10""")
def dense_overfetch(spark, d):
    return _shown(SE.dense_top_k(prototypes(spark, d), bare_vectors(spark, d), label_filter="3", mode="overfetch"))


@query(f"""WITH {CORPUS}, {PROTO}, {SCORED}, r AS (SELECT *, {RANK} AS rank FROM sc)
SELECT query_id, rank, idx, label, round(score, 4) AS score, replace(substring(d.text, 1, 200), chr(10), ' ') AS snippet
FROM r LEFT JOIN documents d ON d.doc_id = r.idx WHERE rank <= 10""")
def hit_display(spark, d):
    corpus = vectors(spark, d)
    return longs(SE.display(SE.with_metadata(SE.dense_top_k(prototypes(spark, d), corpus), corpus)))


@query(f"WITH {CORPUS} SELECT idx, label, 'unknown' AS source, round(list_sum(v), 4) AS total FROM corpus")
def vector_table_round_trip(spark, d):
    path = writers.scratch_dir(spark, "vectors")
    SE.save_vector_table(bare_vectors(spark, d), path)
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return SE.load_vector_table(spark, path).select("idx", "label", "source", F.round(total, 4).alias("total"))


def _ivf(spark, d, queries=None, k=config.TOP_K, nprobe=config.IVF_PROBES):
    path = writers.scratch_dir(spark, "cells")
    cells, centres = SE.assign_cells(bare_vectors(spark, d))
    SE.save_vector_table(cells, path, by_cell=True)
    return SE.ivf_top_k(prototypes(spark, d) if queries is None else queries, SE.load_vector_table(spark, path), centres, k, nprobe)


@query(f"WITH {CORPUS}, {PROTO}, {SCORED}, r AS (SELECT *, {RANK} AS rank FROM sc) SELECT query_id, idx, rank, round(score, 6) AS score FROM r WHERE rank <= 10")
def ivf_all_cells(spark, d):
    """Probing every cell must give the exact result."""
    return _shown(_ivf(spark, d, nprobe=config.IVF_CELLS))


def _every_20th(spark, d):
    return bare_vectors(spark, d).filter("idx % 20 = 0").select(F.col("idx").alias("query_id"), "embedding")


def _others(hits, k=config.TOP_K):
    """Hits but for the query's own row."""
    return SE.top_k(hits.filter("query_id <> idx").drop("rank"), k)


@query()
def ivf_topk(spark, d):
    """The ten nearest others of every 20th vector by the code index."""
    return _shown(_others(C.CodeIndex.build(bare_vectors(spark, d)).search(_every_20th(spark, d), config.TOP_K + 1)))


@query()
def ivf_recall(spark, d):
    """Share of the ten nearest others of every 20th vector that the code index finds."""
    exact = _others(SE.dense_top_k(_every_20th(spark, d), bare_vectors(spark, d), k=config.TOP_K + 1))
    return SE.recall(_others(C.CodeIndex.build(bare_vectors(spark, d)).search(_every_20th(spark, d), config.TOP_K + 1)), exact)


@query("SELECT true AS enough")
def ivf_recall_bound(spark, d):
    """The code index finds nine in ten of the exact hits with its defaults."""
    return ivf_recall(spark, d).select((F.col("recall") >= 0.9).alias("enough"))


@query("SELECT vec_id AS idx, 1 AS n FROM embeddings")
def code_index_cover(spark, d):
    """Every vector is indexed once."""
    index = C.CodeIndex.build(bare_vectors(spark, d))
    return index.codes.filter(F.length("code") == config.CODE_GROUPS).groupBy("idx").agg(F.count("*").cast("int").alias("n"))


# ------------------------------------------------------------------ keywords

def _questions(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _posts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("idx"), "text")


def _bm25_sql(queries, docs="SELECT doc_id AS idx, text FROM documents", k=10):
    tk = S.tokens("lower(text)")
    return f"""dt AS (SELECT idx, {tk} AS tk FROM ({docs})), st AS (SELECT count(*) AS n, avg(len(tk))::DOUBLE AS al FROM dt),
tf AS (SELECT idx, len(tk) AS len, term, count(*) AS tf FROM (SELECT idx, tk, unnest(tk) AS term FROM dt) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tf GROUP BY term), idf0 AS (SELECT term, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS i FROM dfs, st),
idf AS (SELECT term, CASE WHEN i < 0 THEN 0.25::DOUBLE * (SELECT avg(i) FROM idf0) ELSE i END AS i FROM idf0),
qt AS (SELECT query_id, unnest({tk}) AS term FROM ({queries})), qq AS (SELECT query_id, term, count(*) AS qtf FROM qt GROUP BY ALL),
hit AS (SELECT query_id, idx, sum(qtf * i * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / al))) AS s
  FROM qq JOIN tf ON tf.term = qq.term JOIN idf ON idf.term = qq.term, st GROUP BY ALL),
al AS (SELECT q.query_id, x.idx, round(coalesce(hit.s, 0), 9) AS score FROM ({queries}) q CROSS JOIN dt x LEFT JOIN hit ON hit.query_id = q.query_id AND hit.idx = x.idx),
bm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, idx) AS rank FROM al) WHERE rank <= {k})"""


ASK = "SELECT item_id AS query_id, text FROM benchmark"
RARE = "SELECT item_id AS query_id, CASE WHEN item_id % 2 = 0 THEN 'zzqqx' ELSE string_split(text, ' ')[4] || ' zzqqx' END AS text FROM benchmark"


@query(f"WITH {_bm25_sql(ASK)} SELECT query_id, idx, rank, round(score, 6) AS score FROM bm")
def bm25_topk(spark, d):
    return _shown(SE.bm25_top_k(_questions(spark, d), _posts(spark, d)))


@query(f"WITH {_bm25_sql(RARE)} SELECT query_id, idx, rank, round(score, 6) AS score FROM bm")
def bm25_filled_up(spark, d):
    """Queries with few or no matching documents are filled up with score 0."""
    word = F.when(F.col("query_id") % 2 == 0, "zzqqx").otherwise(F.concat(F.get(F.split("text", " "), F.lit(3)), F.lit(" zzqqx")))
    return _shown(SE.bm25_top_k(_questions(spark, d).withColumn("text", word), _posts(spark, d)))


@query(f"WITH {_bm25_sql(ASK)} SELECT n AS n_docs, round(al, 6) AS avg_len, round((SELECT avg(i) FROM idf0), 6) AS mean_idf FROM st")
def bm25_statistics(spark, d):
    s = SE.bm25_statistics(_posts(spark, d))
    return s.select("n_docs", F.round("avg_len", 6).alias("avg_len"), F.round("mean_idf", 6).alias("mean_idf"))


@query(f"""WITH {CORPUS}, {_bm25_sql(ASK, k=3)}, dq AS (SELECT item_id AS query_id, corpus.v FROM benchmark JOIN corpus ON idx = item_id),
ds AS (SELECT query_id, corpus.idx, round(list_inner_product(dq.v, corpus.v), 9) AS score FROM dq CROSS JOIN corpus),
dr AS (SELECT * FROM (SELECT *, {RANK} AS rank FROM ds) WHERE rank <= 10)
SELECT coalesce(dr.query_id, bm.query_id) AS query_id, coalesce(dr.idx, bm.idx) AS idx, dr.rank AS dense_rank, bm.rank AS bm25_rank,
  round(dr.score, 6) AS dense_score, round(bm.score, 6) AS bm25_score FROM dr FULL OUTER JOIN bm ON bm.query_id = dr.query_id AND bm.idx = dr.idx""")
def dense_vs_bm25(spark, d):
    """The same batch of queries through both searches; a query's vector is the one with its id."""
    corpus = bare_vectors(spark, d)
    asked = _questions(spark, d)
    dense = SE.dense_top_k(asked.join(corpus.select(F.col("idx").alias("query_id"), "embedding"), "query_id"), corpus)
    both = SE.compare(dense, SE.bm25_top_k(asked, _posts(spark, d), k=3))
    return longs(both.withColumns({c: F.round(c, 6) for c in ("dense_score", "bm25_score")}))
