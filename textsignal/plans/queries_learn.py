"""Registered queries: trained models. Their numbers depend on the solver, so they are checked by
invariants: here where SQL can state them, else in the tests."""
from pyspark.sql import functions as F

from textsignal.functions import text as X
from textsignal.operators import classify as C, embeddings as EM, lda as LDA, search as SE, tokens as TK, topics as T
from textsignal.operators.bounds import local_table
from textsignal.plans import inputs as I, sql as S, stages
from textsignal.plans.inputs import longs, table
from textsignal.sources import writers

QUERIES, SQL = {}, {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def stated(sql):
    def register(fn):
        SQL[fn.__name__] = sql
        return query(fn)
    return register


def _labelled(spark, d):
    """Documents with a class to learn: their toxicity flag, by name."""
    labels = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("label"))
    return table(spark, d, "documents").join(labels, "doc_id").select("doc_id", X.clean_deep(F.col("text")).alias("text"), "label")


def _classical(spark, d):
    """The same documents as the word models read them: stop words dropped, lemmas joined by blanks."""
    docs = _labelled(spark, d)
    kept = docs.select("doc_id", X.remove_stopwords(X.tokenize(F.col("text"))).alias("tokens"))
    lemmas = TK.lemmatize(kept, "doc_id", local_table(spark, {"token": list(I.LEMMAS), "lemma": list(I.LEMMAS.values())}, "token string, lemma string"))
    return lemmas.join(docs.select("doc_id", "label"), "doc_id").select("doc_id", F.array_join("tokens", " ").alias("text"), "label")


def _tokens(spark, d):
    clean = X.remove_stopwords(X.tokenize(X.clean_deep(F.col("text"))))
    return table(spark, d, "documents").select("doc_id", clean.alias("tokens"))


@query
def train_rank_models(spark, d):
    scores, _, _, _ = C.train_and_rank(_classical(spark, d), "text", "label", "doc_id")
    return longs(scores)


@stated("""WITH t AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS label FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL),
n AS (SELECT label, count(*) AS n FROM t GROUP BY label)
SELECT m.model, sum(round(0.15::DOUBLE * n))::BIGINT AS n_tested, count(*) AS n_classes, 1::BIGINT AS per_document, true AS known
FROM n CROSS JOIN (VALUES ('BoW + LogReg'), ('TF-IDF + LogReg'), ('TF-IDF + SVM'), ('TF-IDF + RF')) m(model) GROUP BY m.model""")
def train_rank_models_tested(spark, d):
    """Every model labels every document of the stratified test part once, with one of the classes."""
    _, predictions, _, _ = C.train_and_rank(_classical(spark, d), "text", "label", "doc_id", trees=50, max_depth=12)
    once = (F.count("*") / F.count_distinct("doc_id")).cast("long")
    out = predictions.groupBy("model").agg(F.count_distinct("doc_id").alias("n_tested"), F.count_distinct("y_true").alias("n_classes"), once.alias("per_document"),
                                           F.min(F.coalesce(F.col("y_pred").isin("toxic", "clean"), F.lit(False))).alias("known"))
    return longs(out)


@query
def fit_with_validation(spark, d):
    _, report, _, _ = C.fit_with_validation(_labelled(spark, d), "text", "label", "doc_id")
    return report


@stated("""WITH t AS (SELECT CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS label FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL),
n AS (SELECT label, round(0.15::DOUBLE * count(*))::BIGINT AS support FROM t GROUP BY label)
SELECT label AS class, support, true AS sound FROM n UNION ALL SELECT c, sum(support)::BIGINT, true FROM n CROSS JOIN (VALUES ('macro avg'), ('weighted avg')) x(c) GROUP BY c""")
def fit_with_validation_shape(spark, d):
    """The report covers the held-out part by class, and its scores are shares."""
    shares = [F.col(c).isNull() | F.col(c).between(0, 1) for c in ("precision", "recall", "f1")]
    return longs(fit_with_validation(spark, d).filter(F.col("class") != "accuracy").select("class", F.col("support").cast("long").alias("support"), (shares[0] & shares[1] & shares[2]).alias("sound")))


@query
def predict_batch(spark, d):
    """Train, save, load, and label every document."""
    model, _, label_map, _ = C.fit_with_validation(_labelled(spark, d), "text", "label", "doc_id", strengths=(1.0,))
    path = writers.scratch_dir(spark, "classifier")
    C.save_model(model, path)
    names = [r["label"] for r in label_map.orderBy("id").collect()]
    out = C.predict(C.load_model(path), table(spark, d, "documents").select("doc_id", X.clean_deep(F.col("text")).alias("text")), "text", names, "doc_id")
    return out.select("doc_id", "label", F.get("ranking", F.lit(0))["probability"].alias("probability"))


@stated("SELECT doc_id, true AS known, true AS probable FROM documents")
def predict_batch_cover(spark, d):
    """Every document gets one of the classes, with at least the probability of an even guess."""
    out = predict_batch(spark, d)
    return out.select("doc_id", F.col("label").isin("toxic", "clean").alias("known"), (F.col("probability") >= 0.5).alias("probable"))


@query
def word_neighbours(spark, d):
    words = EM.word_table(EM.train_word_vectors(_tokens(spark, d)))
    probes = spark.createDataFrame([(w,) for w in PROBES], "probe string")
    return longs(EM.word_neighbours(words, probes))


PROBES = ["stupid", "worthless", "license", "copyright", "medication"]


@stated(f"""WITH t AS (SELECT unnest({S.kept(S.word_tokens(S.deep('text')))}) AS word FROM documents), n AS (SELECT word, count(*) AS n FROM t GROUP BY word)
SELECT probe, coalesce(n >= 3, false) AS known, CASE WHEN n >= 3 THEN 5 ELSE 0 END::BIGINT AS n_neighbours, true AS sound FROM {S.values([(w,) for w in PROBES])} p(probe) LEFT JOIN n ON word = probe""")
def word_neighbours_known(spark, d):
    """Words used three times are known and have five other words as neighbours, best first."""
    near = word_neighbours(spark, d)
    sound = F.min(F.col("neighbour").isNull() | ((F.col("neighbour") != F.col("probe")) & F.col("score").between(-1.000001, 1.000001)))
    return longs(near.groupBy("probe", "known").agg(F.count_distinct("neighbour").alias("n_neighbours"), sound.alias("sound")))


@query
def word_analogy(spark, d):
    words = EM.word_table(EM.train_word_vectors(_tokens(spark, d)))
    return longs(EM.word_analogy(words, ["stupid", "license"], ["worthless"]))


@query
def lda_topics(spark, d):
    return longs(LDA.fit(_tokens(spark, d)).topic_terms())


@query
def lda_topics_json(spark, d):
    return writers.map_json(T.topic_word_lists(LDA.fit(_tokens(spark, d)).topic_terms()), "topic", "words")


@stated("SELECT range::BIGINT AS topic, 8::BIGINT AS n_words, true AS ordered FROM range(10)")
def lda_topics_shape(spark, d):
    """Ten topics of eight different words, heaviest first."""
    words = lda_topics(spark, d).groupBy("topic").agg(
        F.count_distinct("term").alias("n_words"),
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "weight"))), lambda s: s["weight"]).alias("w"))
    return longs(words.select("topic", "n_words", (F.col("w") == F.sort_array("w", asc=False)).alias("ordered")))


def _clusters(spark, d):
    tokens = _tokens(spark, d)
    vectors = EM.document_vectors(tokens, EM.train_word_vectors(tokens, size=64), "doc_id")
    assigned = T.cluster_documents(vectors, "doc_id")
    path = writers.scratch_dir(spark, "topics")
    writers.write_table(assigned, path)
    return tokens, spark.read.parquet(path)


@query
def topic_clusters(spark, d):
    """Cluster of every document."""
    _, assigned = _clusters(spark, d)
    return longs(assigned)


@stated("SELECT doc_id, true AS placed FROM documents")
def topic_clusters_cover(spark, d):
    """Every document has one of the topics or is an outlier."""
    return topic_clusters(spark, d).select("doc_id", F.col("topic").between(-1, 19).alias("placed"))


@query
def topic_info(spark, d):
    tokens, assigned = _clusters(spark, d)
    tokens = tokens.join(assigned.select("doc_id", "topic"), "doc_id")
    keys = T.keywords(T.class_tfidf(tokens, "topic"), "topic")
    info = T.topic_info(assigned, keys, table(spark, d, "documents"), "doc_id", "text")
    return info.select("topic", "count", "name", F.array_join("representation", " ").alias("representation"),
                       F.size("representative_docs").cast("long").alias("n_docs"))


@query
def document_vector_search(spark, d):
    """Vectors from trained word vectors; each query text is encoded by the same model."""
    model = EM.train_word_vectors(_tokens(spark, d), size=64)
    corpus = EM.document_vectors(_tokens(spark, d), model, "doc_id").withColumnsRenamed({"doc_id": "idx"})
    asked = table(spark, d, "benchmark").select("item_id", X.remove_stopwords(X.tokenize(X.clean_deep(F.col("text")))).alias("tokens"))
    queries = EM.document_vectors(asked, model, "item_id").withColumnRenamed("item_id", "query_id")
    hits = SE.dense_top_k(queries, corpus.withColumn("label", F.lit("unknown")))
    return longs(hits.withColumn("score", F.round("score", 6)))


@stated("SELECT item_id AS query_id, 10::BIGINT AS n_hits, true AS ordered FROM benchmark")
def document_vector_search_shape(spark, d):
    """Ten documents for every query text, best first, by cosines."""
    hits = document_vector_search(spark, d).groupBy("query_id").agg(
        F.count_distinct("idx").alias("n_hits"), F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda s: s["score"]).alias("s"))
    cosines = F.forall("s", lambda x: x.between(-1.000001, 1.000001))
    return longs(hits.select("query_id", "n_hits", ((F.col("s") == F.sort_array("s", asc=False)) & cosines).alias("ordered")))


@stated("""SELECT 0::BIGINT AS topics_without_summary, 0::BIGINT AS empty_summaries, count(*) AS n_posts FROM documents WHERE text IS NOT NULL""")
def topic_summaries(spark, d):
    """Topics of trained vectors as clusters of the summaries: every topic is summarised, from all of its posts."""
    _, assigned = _clusters(spark, d)
    posts = table(spark, d, "documents").select(F.col("doc_id").alias("post_id"), "text").join(assigned.select(F.col("doc_id").alias("post_id"), "topic"), "post_id")
    summaries, _ = stages.summarize_corpus(posts)
    found = assigned.select("topic").distinct().join(summaries.withColumnRenamed("cluster_id", "topic"), "topic", "left")
    return found.agg(F.count(F.when(F.col("n_posts").isNull(), 1)).alias("topics_without_summary"),
                     F.count(F.when((F.length("extractive_summary") == 0) | (F.length("centroid_summary") == 0), 1)).alias("empty_summaries"), F.sum("n_posts").alias("n_posts"))


def _letters():
    """A caller's own encoder: how often a few letters occur."""
    return lambda texts: [[float(t.count(c)) for c in "aeiou"] for t in texts]


LETTERS = ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::DOUBLE" for c in "aeiou")


@stated(f"""WITH v AS (SELECT doc_id, [{LETTERS}] AS v FROM documents WHERE text IS NOT NULL), n AS (SELECT doc_id, v, sqrt(list_inner_product(v, v)) AS n FROM v)
SELECT doc_id, round(CASE WHEN n > 0 THEN v[1] / n ELSE 0 END, 6) AS a, round(CASE WHEN n > 0 THEN v[5] / n ELSE 0 END, 6) AS u FROM n""")
def own_encoder(spark, d):
    """Vectors from the caller's own model, unit length."""
    out = EM.encode_with(table(spark, d, "documents"), "doc_id", "text", _letters)
    return out.select("doc_id", *[F.round(F.get("embedding", F.lit(i)), 6).alias(c) for c, i in (("a", 0), ("u", 4))])
