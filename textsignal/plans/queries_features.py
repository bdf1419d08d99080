"""Registered queries: term statistics, splits, metrics, summaries, ROUGE, topic keywords."""
from pyspark.sql import functions as F

from textsignal import vocab
from textsignal.functions import text as X, vectors as V
from textsignal.operators import features as FE, metrics as M, rouge as R, splits as SP, summarize as SU, tokens as TK, topics as T
from textsignal.operators.bounds import local_table
from textsignal.plans import sql as S
from textsignal.plans.inputs import joined, longs, table

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return register


def docs(spark, d):
    return table(spark, d, "documents")


# ------------------------------------------------------------------ terms

def _grams(spark, d, n):
    return FE.with_terms(docs(spark, d).select("doc_id", "text"), "text", n).select("doc_id", "terms")


W = f"w AS (SELECT doc_id, {S.feature_tokens('text')} AS tk FROM documents)"
UNI = W + ", t AS (SELECT doc_id, unnest(tk) AS term FROM w)"
BI = W + f", t AS (SELECT doc_id, unnest(list_concat(tk, {S.bigrams('tk')})) AS term FROM w)"
STATS = "c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL), s AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM c GROUP BY term)"


@query(f"WITH {UNI}, {STATS} SELECT * FROM s")
def term_df(spark, d):
    return FE.corpus_counts(_grams(spark, d, 1))


@query(f"WITH {W} SELECT g AS gram, count(*) AS n FROM (SELECT unnest({S.bigrams('tk')}) AS g FROM w) GROUP BY g")
def bigram_counts(spark, d):
    words = docs(spark, d).select("doc_id", X.features_tokens(F.col("text")).alias("tokens"))
    pairs = TK.adjacent_pairs(TK.explode_tokens(words, "doc_id"), "doc_id")
    return pairs.groupBy("gram").agg(F.count("*").alias("n"))


@query(f"WITH {BI}, {STATS} SELECT term, df, cf FROM s ORDER BY cf DESC, term LIMIT 10000")
def bow_top_terms(spark, d):
    return FE.top_terms(FE.corpus_counts(_grams(spark, d, 2)))


TFIDF_SQL = """, v AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM w)) / (1.0::DOUBLE + df)) + 1 AS idf FROM s ORDER BY cf DESC, term LIMIT 10000),
x AS (SELECT c.doc_id, c.term, c.tf, c.tf * v.idf AS raw FROM c JOIN v ON v.term = c.term)
SELECT doc_id, term, tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM x"""


def _weights(spark, d, n):
    # Texts are hashed by id, not the n-grams that are made of them.
    hashed = FE.hashed_texts(spark.read.parquet(f"{d}/documents.parquet"), "doc_id", "text")
    return FE.tfidf(FE.with_terms(hashed, "text", n).select("doc_id", "terms"), "doc_id", hashed=True).withColumn("weight", F.round("weight", 6))


@query(f"WITH {BI}, {STATS}{TFIDF_SQL}")
def tfidf_weights(spark, d):
    return _weights(spark, d, 2)


@query(f"WITH {UNI}, {STATS}{TFIDF_SQL}")
def tfidf_unigrams(spark, d):
    return _weights(spark, d, 1)


PRUNED = "p AS (SELECT * FROM s WHERE df >= 5 AND df <= 0.5 * (SELECT count(*) FROM w))"


@query(f"WITH {UNI}, {STATS}, {PRUNED} SELECT * FROM p")
def pruned_dictionary(spark, d):
    terms = _grams(spark, d, 1)
    return FE.prune_terms(FE.corpus_counts(terms), FE.document_count(terms))


@query(f"WITH {UNI}, {STATS}, {PRUNED} SELECT c.* FROM c JOIN p ON p.term = c.term")
def document_bags(spark, d):
    terms = _grams(spark, d, 1)
    return FE.bag_of_words(terms, "doc_id", FE.prune_terms(FE.corpus_counts(terms), FE.document_count(terms)))


@query("""WITH r AS (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM documents)
SELECT least(floor((n_chars - lo)::DOUBLE * 50 / (hi - lo)) + 1, 50)::BIGINT AS bin, count(*) AS n FROM documents, r GROUP BY ALL""")
def score_histogram(spark, d):
    return longs(FE.histogram(docs(spark, d).select("n_chars"), "n_chars"))


# ------------------------------------------------------------------ splits and labels

SPLIT = "r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42-' || doc_id), doc_id) AS rk, count(*) OVER (PARTITION BY lang) AS n FROM documents)"


@query(f"WITH {SPLIT} SELECT doc_id, lang, CASE WHEN rk <= round(0.15::DOUBLE * n) THEN 'test' ELSE 'train' END AS split FROM r")
def stratified_split(spark, d):
    return SP.stratified_split(docs(spark, d).select("doc_id", "lang"), "lang", "doc_id", [("test", 0.15)])


@query(f"""WITH {SPLIT} SELECT doc_id, lang, CASE WHEN rk <= round(0.15::DOUBLE * n) THEN 'test' WHEN rk <= round(0.3::DOUBLE * n) THEN 'val'
ELSE 'train' END AS split FROM r""")
def three_way_split(spark, d):
    return SP.stratified_split(docs(spark, d).select("doc_id", "lang"), "lang", "doc_id", [("test", 0.15), ("val", 0.15)])


@query("SELECT doc_id, source, dense_rank() OVER (ORDER BY source) - 1 AS code FROM documents")
def label_encode(spark, d):
    return longs(SP.encode_labels(docs(spark, d).select("doc_id", "source"), "source"))


@query("SELECT doc_id, source FROM documents")
def label_decode(spark, d):
    df = docs(spark, d).select("doc_id", "source")
    coded = SP.encode_labels(df, "source").drop("source")
    return SP.decode_labels(coded, SP.label_codes(df, "source")).select("doc_id", "source")


# ------------------------------------------------------------------ metrics, on predictions made by rule

def _preds(spark, d):
    true = F.concat(F.lit("c"), F.col("quality") * 2 + F.col("toxic"))
    other = F.concat(F.lit("c"), F.col("doc_id") % 4)
    models = F.explode(F.array(*[F.lit(m) for m in (0, 1, 2)]))
    return (table(spark, d, "labels").select("doc_id", true.alias("y_true"), other.alias("o"), models.alias("m"))
            .select("doc_id", "y_true", F.concat(F.lit("model "), "m").alias("model"), F.col("m").alias("position"),
                    F.when(F.col("doc_id") % (F.col("m") + 3) == 0, F.col("o")).otherwise(F.col("y_true")).alias("y_pred")))


PREDS = """p0 AS (SELECT doc_id, 'c' || (quality * 2 + toxic) AS y_true, m, CASE WHEN doc_id % (m + 3) = 0 THEN 'c' || (doc_id % 4)
  ELSE 'c' || (quality * 2 + toxic) END AS y_pred, 'model ' || m AS model FROM labels, (VALUES (0), (1), (2)) v(m)),
k AS (SELECT DISTINCT model, c FROM (SELECT model, y_true AS c FROM p0 UNION ALL SELECT model, y_pred FROM p0)),
q AS (SELECT k.model, k.c AS class, count(*) FILTER (y_true = c) AS support, count(*) FILTER (y_pred = c) AS predicted,
  count(*) FILTER (y_true = c AND y_pred = c) AS hits FROM k JOIN p0 ON p0.model = k.model GROUP BY ALL),
f0 AS (SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END::DOUBLE AS precision, CASE WHEN support > 0 THEN hits / support ELSE 0 END::DOUBLE AS recall FROM q),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END::DOUBLE AS f1 FROM f0),
a AS (SELECT model, avg((y_true = y_pred)::INT)::DOUBLE AS acc FROM p0 GROUP BY model)"""


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query(f"""WITH {PREDS} SELECT model, class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support::DOUBLE AS support FROM f
UNION ALL SELECT model, 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), round(acc, 6) FROM a
UNION ALL SELECT model, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::DOUBLE FROM f GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
  round(sum(f1 * support) / sum(support), 6), sum(support)::DOUBLE FROM f GROUP BY model""")
def classification_report(spark, d):
    return _rounded(M.report(_preds(spark, d), ["model"]), "precision", "recall", "f1", "support")


RANKED = f"WITH {PREDS}, z AS (SELECT f.model, acc AS accuracy, sum(f1 * support) / sum(support) AS f1_weighted FROM f JOIN a ON a.model = f.model GROUP BY f.model, acc)"


@query(f"{RANKED} SELECT model, round(accuracy, 6) AS accuracy, round(f1_weighted, 6) AS f1_weighted FROM z ORDER BY f1_weighted DESC")
def model_ranking(spark, d):
    return _rounded(M.ranking(_preds(spark, d)), "accuracy", "f1_weighted")


def _best(spark, d):
    return M.best_model(M.ranking(_preds(spark, d)).withColumn("position", F.substring("model", 7, 9).cast("int")))


@query(f"{RANKED} SELECT model, round(f1_weighted, 6) AS f1_weighted FROM z ORDER BY z.f1_weighted DESC, model LIMIT 1")
def best_model(spark, d):
    return _rounded(_best(spark, d), "f1_weighted").select("model", "f1_weighted")


@query(f"{RANKED}, b AS (SELECT model FROM z ORDER BY f1_weighted DESC, model LIMIT 1) SELECT doc_id, y_true, y_pred FROM p0 JOIN b ON b.model = p0.model")
def best_model_predictions(spark, d):
    return M.best_predictions(_preds(spark, d), _best(spark, d)).select("doc_id", "y_true", "y_pred")


CONFUSED = f"""WITH {PREDS}, l AS (SELECT DISTINCT c FROM k), n AS (SELECT y_true, y_pred, count(*) AS n FROM p0 GROUP BY ALL),
m AS (SELECT x.c AS y_true, y.c AS y_pred, coalesce(n.n, 0) AS n FROM l x CROSS JOIN l y LEFT JOIN n ON n.y_true = x.c AND n.y_pred = y.c)"""


@query(CONFUSED + " SELECT y_true, y_pred, n FROM m")
def confusion_matrix(spark, d):
    return M.confusion_long(_preds(spark, d))


@query(CONFUSED + """ SELECT y_true, max(n) FILTER (y_pred = 'c0') AS c0, max(n) FILTER (y_pred = 'c1') AS c1, max(n) FILTER (y_pred = 'c2') AS c2,
max(n) FILTER (y_pred = 'c3') AS c3 FROM m GROUP BY y_true""")
def confusion_matrix_wide(spark, d):
    return M.confusion_wide(_preds(spark, d), ["c0", "c1", "c2", "c3"])


LOGITS = "[sin(n_chars), cos(n_chars), (doc_id % 7) / 7.0::DOUBLE, (n_chars % 5) / 5.0::DOUBLE]"


def _logits():
    return F.array(F.sin(F.col("n_chars").cast("double")), F.cos(F.col("n_chars").cast("double")),
                   F.col("doc_id") % 7 / 7.0, F.col("n_chars") % 5 / 5.0)


SOFTMAX = f"""x AS (SELECT doc_id, {LOGITS} AS z FROM documents),
e AS (SELECT doc_id, unnest(z) AS s, exp(unnest(z) - list_max(z)) AS p, unnest(['a', 'b', 'c', 'd']) AS label, unnest(range(4)) AS i FROM x),
pr AS (SELECT doc_id, label, i, s, p / sum(p) OVER (PARTITION BY doc_id) AS prob FROM e)"""


@query(f"""WITH {SOFTMAX}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(prob, 4) DESC, label) AS rk,
  row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, i) AS top FROM pr)
SELECT doc_id, max(label) FILTER (rk = 1) AS best, string_agg(label, '|' ORDER BY rk) AS ranking, round(max(prob), 4) AS prob, max(i) FILTER (top = 1) AS argmax
FROM r GROUP BY doc_id""")
def ranked_labels(spark, d):
    df = docs(spark, d).select("doc_id", _logits().alias("z"))
    labels = F.array(*[F.lit(l) for l in "abcd"])
    df = df.withColumn("r", V.ranked_labels(labels, V.softmax(F.col("z"))))
    return longs(df.select("doc_id", F.get("r", F.lit(0))["label"].alias("best"), joined(F.transform("r", lambda s: s["label"])).alias("ranking"),
                           F.get("r", F.lit(0))["probability"].alias("prob"), V.argmax(F.col("z")).alias("argmax")))


@query(f"WITH {SOFTMAX} SELECT doc_id, label, round(prob, 6) AS prob, row_number() OVER (PARTITION BY doc_id ORDER BY prob DESC, label) AS rank FROM pr")
def probability_ranks(spark, d):
    probs = docs(spark, d).select("doc_id", F.posexplode_outer(V.softmax(_logits())).alias("i", "prob"))
    labelled = probs.select("doc_id", F.get(F.array(*[F.lit(l) for l in "abcd"]), F.col("i")).alias("label"), "prob")
    return longs(_rounded(M.ranked_probabilities(labelled, "doc_id"), "prob"))


# ------------------------------------------------------------------ summaries

MEGA = """rk AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n
  FROM documents WHERE text IS NOT NULL AND source IS NOT NULL),
mega AS (SELECT source AS id, max(n) AS n_posts, string_agg(text, ' ' ORDER BY doc_id) FILTER (rn <= 15) AS body FROM rk GROUP BY source)"""
PER_DOC = "mega AS (SELECT doc_id AS id, text AS body FROM documents)"


def _ranked_sql(score):
    """Sentences → scores → joined summary; `score` defines table `sc(id, sent, score)`."""
    return f"""sp AS (SELECT id, body, {S.sentences('body')} AS s FROM mega),
se AS (SELECT id, len(s) AS n_sent, unnest(range(len(s))) AS sent, unnest(s) AS sentence FROM sp),
tm AS (SELECT id, n_sent, sent, unnest(list_filter({S.feature_tokens('sentence')}, lambda x: x NOT IN {S.in_list(vocab.STOPWORDS)})) AS term FROM se),
tf AS (SELECT id, n_sent, sent, term, count(*) AS tf FROM tm GROUP BY ALL),
{score},
rs AS (SELECT se.id, se.sent, sentence, row_number() OVER (PARTITION BY se.id ORDER BY coalesce(score, 0) DESC, se.sent DESC) AS r
  FROM se LEFT JOIN sc ON sc.id = se.id AND sc.sent = se.sent),
best AS (SELECT id, string_agg(sentence, ' ' ORDER BY sent) AS s FROM rs WHERE r <= 3 GROUP BY id),
out AS (SELECT sp.id, body, CASE WHEN len(sp.s) <= 3 THEN body ELSE best.s END AS summary FROM sp LEFT JOIN best ON best.id = sp.id)"""


EXTRACTIVE = """w AS (SELECT id, sent, tf * (ln((1.0::DOUBLE + n_sent) / (1.0::DOUBLE + count(*) OVER (PARTITION BY id, term))) + 1) AS w FROM tf),
sc AS (SELECT id, sent, round(sum(w) / sqrt(sum(w * w)), 9) AS score FROM w GROUP BY ALL)"""
CENTROID = """idf AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM mega)) / (1.0::DOUBLE + count(DISTINCT id))) + 1 AS idf FROM tf GROUP BY term),
w AS (SELECT id, sent, tf.term, tf * idf AS w, sum(tf * idf) OVER (PARTITION BY id, tf.term) AS c FROM tf JOIN idf ON idf.term = tf.term),
cn AS (SELECT id, sqrt(sum(c * c)) AS cn FROM (SELECT DISTINCT id, term, c FROM w) GROUP BY id),
sc AS (SELECT w.id, sent, round(sum(w * c) / (sqrt(sum(w * w)) * max(cn)), 9) AS score FROM w JOIN cn ON cn.id = w.id GROUP BY ALL)"""


@query(f"WITH {MEGA} SELECT id AS source, n_posts, md5(body) AS document_md5 FROM mega")
def cluster_megadoc(spark, d):
    return (SU.cluster_documents(docs(spark, d), "source", "doc_id", 15)
            .select("source", "n_posts", F.md5("document").alias("document_md5")))


@query(f"WITH {PER_DOC}, {_ranked_sql(EXTRACTIVE)} SELECT id AS doc_id, summary AS extractive_summary FROM out")
def extractive_summary(spark, d):
    return SU.extractive(docs(spark, d).select("doc_id", "text"), "doc_id", "text").select("doc_id", "extractive_summary")


CENTROID_OUT = f"SELECT id, CASE WHEN len({S.tokens('body')}) < 50 THEN body ELSE summary END AS s FROM out"


@query(f"WITH {PER_DOC}, {_ranked_sql(CENTROID)} SELECT id AS doc_id, s AS centroid_summary FROM ({CENTROID_OUT})")
def centroid_summary(spark, d):
    return SU.centroid(docs(spark, d).select("doc_id", "text"), "doc_id", "text").select("doc_id", "centroid_summary")


# Sentences of all posts of a cluster: each cluster is one corpus, its sentences in order of post and place.
CLUSTER_TERMS = f"""sp AS (SELECT source AS id, doc_id AS post, {S.sentences('text')} AS s FROM documents WHERE text IS NOT NULL AND source IS NOT NULL),
se AS (SELECT id, post, unnest(range(len(s))) AS sent, unnest(s) AS sentence FROM sp),
n AS (SELECT id, count(*) AS n_sent FROM se GROUP BY id),
tm AS (SELECT id, post, sent, unnest(list_filter({S.feature_tokens('sentence')}, lambda x: x NOT IN {S.in_list(vocab.STOPWORDS)})) AS term FROM se),
tf AS (SELECT id, post, sent, term, count(*) AS tf FROM tm GROUP BY ALL)"""
CLUSTER_EXTRACTIVE = """d AS (SELECT id, term, count(*) AS df FROM tf GROUP BY ALL),
w1 AS (SELECT tf.id, post, sent, tf * (ln((1.0::DOUBLE + n_sent) / (1.0::DOUBLE + df)) + 1) AS w
  FROM tf JOIN d ON d.id = tf.id AND d.term = tf.term JOIN n ON n.id = tf.id),
s1 AS (SELECT id, post, sent, round(sum(w) / sqrt(sum(w * w)), 9) AS score FROM w1 GROUP BY ALL)"""
CLUSTER_CENTROID = """i AS (SELECT term, ln((1.0::DOUBLE + (SELECT count(*) FROM n)) / (1.0::DOUBLE + count(DISTINCT id))) + 1 AS idf FROM tf GROUP BY term),
w2 AS (SELECT id, post, sent, tf.term, tf * idf AS w FROM tf JOIN i ON i.term = tf.term),
c AS (SELECT id, term, sum(w) AS c FROM w2 GROUP BY ALL), cn AS (SELECT id, sqrt(sum(c * c)) AS cn FROM c GROUP BY id),
s2 AS (SELECT w2.id, post, sent, round(sum(w * c) / (sqrt(sum(w * w)) * max(cn)), 9) AS score
  FROM w2 JOIN c ON c.id = w2.id AND c.term = w2.term JOIN cn ON cn.id = w2.id GROUP BY ALL)"""


def _best_of_cluster(scores):
    return f"""(SELECT id, string_agg(sentence, ' ' ORDER BY post, sent) AS summary FROM (
  SELECT se.id, se.post, se.sent, sentence, row_number() OVER (PARTITION BY se.id ORDER BY coalesce(score, 0) DESC, se.post DESC, se.sent DESC) AS r
  FROM se LEFT JOIN {scores} s ON s.id = se.id AND s.post = se.post AND s.sent = se.sent) WHERE r <= 3 GROUP BY id)"""


@query(f"""WITH {CLUSTER_TERMS}, {CLUSTER_EXTRACTIVE}, {CLUSTER_CENTROID}, 
p AS (SELECT source AS id, count(*) AS n_posts, string_agg(text, ' ' ORDER BY doc_id) FILTER (r <= 3) AS body FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents WHERE text IS NOT NULL AND source IS NOT NULL) GROUP BY source)
SELECT p.id AS cluster_id, n_posts, coalesce(a.summary, body) AS extractive_summary, coalesce(b.summary, body) AS centroid_summary
FROM p LEFT JOIN {_best_of_cluster('s1')} a ON a.id = p.id LEFT JOIN {_best_of_cluster('s2')} b ON b.id = p.id""")
def cluster_summaries(spark, d):
    return SU.summarize_clusters(docs(spark, d), "source", "doc_id")


CLEANED = f"SELECT source AS id, {S.deep('text')} AS text, doc_id FROM documents"


@query(f"""WITH c AS ({CLEANED}), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY doc_id) AS rn FROM c)
SELECT id AS source, string_agg(text, ' ' ORDER BY doc_id) AS extractive_summary FROM r WHERE rn <= 15 GROUP BY id""")
def summary_of_cleaned_text(spark, d):
    """Cleaned text has no sentence marks, so the whole input is one sentence and comes back."""
    cleaned = docs(spark, d).select("source", "doc_id", X.clean_deep(F.col("text")).alias("text"))
    mega = SU.cluster_documents(cleaned, "source", "doc_id", 15)
    return SU.extractive(mega, "source", "document").select("source", "extractive_summary")


# ------------------------------------------------------------------ ROUGE, a turn against the answer to it

def _pairs(spark, d):
    turns = table(spark, d, "conversations")
    a = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("reference"))
    b = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("generated"))
    return a.join(b, ["conv_id", "turn"]).select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), "generated", "reference")


PAIRS = """pairs AS (SELECT a.conv_id * 1000 + a.turn AS pair_id, regexp_extract_all(lower(b.text), '[a-z0-9]+') AS gen, regexp_extract_all(lower(a.text), '[a-z0-9]+') AS ref
FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user')"""


def _rouge_sql(gen, ref, name):
    return f"""g AS (SELECT pair_id, gram, sum(a)::BIGINT AS a, sum(b)::BIGINT AS b FROM (SELECT pair_id, unnest({gen}) AS gram, 1 AS a, 0 AS b FROM pairs
  UNION ALL SELECT pair_id, unnest({ref}), 0, 1 FROM pairs) GROUP BY ALL),
o AS (SELECT pair_id, sum(least(a, b)) AS o, sum(a) AS a, sum(b) AS b FROM g GROUP BY pair_id)
SELECT pairs.pair_id, round(coalesce(CASE WHEN o > 0 THEN 2 * (o / a) * (o / b) / (o / a + o / b) END, 0), 6) AS {name}
FROM pairs LEFT JOIN o ON o.pair_id = pairs.pair_id"""


@query(f"WITH {PAIRS}, {_rouge_sql('gen', 'ref', 'rouge1')}")
def rouge1(spark, d):
    t = R.tokenized_pairs(_pairs(spark, d), "pair_id")
    return _rounded(R.rouge_n(t, "pair_id", 1), "rouge1")


@query(f"WITH {PAIRS}, {_rouge_sql(S.bigrams('gen'), S.bigrams('ref'), 'rouge2')}")
def rouge2(spark, d):
    t = R.tokenized_pairs(_pairs(spark, d), "pair_id")
    return _rounded(R.rouge_n(t, "pair_id", 2), "rouge2")


# One row of the table of common subsequences per step.
LCS = """l(pair_id, i, gen, ref, above) AS (SELECT pair_id, 0::BIGINT, gen, ref, list_transform(range(len(ref) + 1), lambda j: 0::BIGINT) FROM pairs
  UNION ALL SELECT pair_id, i + 1, gen, ref, list_reduce(range(1, len(ref) + 1), lambda row, j: list_append(row, CASE
    WHEN gen[i + 1] = ref[j] THEN above[j] + 1 ELSE greatest(above[j + 1], row[j]) END), [0::BIGINT]) FROM l WHERE i < len(gen)),
lo AS (SELECT pair_id, above[-1] AS o, len(gen) AS a, len(ref) AS b FROM l WHERE i = len(gen)),
rl AS (SELECT pair_id, round(CASE WHEN o > 0 THEN 2 * (o / a) * (o / b) / (o / a + o / b) ELSE 0 END, 6) AS "rougeL" FROM lo)"""


@query(f'WITH RECURSIVE {PAIRS}, {LCS} SELECT pair_id, "rougeL" FROM rl')
def rougeL(spark, d):
    t = R.tokenized_pairs(_pairs(spark, d), "pair_id")
    return _rounded(R.rouge_l(t, "pair_id"), "rougeL")


_STEMMED = "list_transform({0}, lambda x: CASE WHEN length(x) > 3 THEN m[x] ELSE x END) AS {0}"
STEMMED_PAIRS = f"""{PAIRS.replace('pairs AS', 'plain AS', 1)}, v AS (SELECT unnest(gen || ref) AS token FROM plain), {S.stems('v')},
by_word AS (SELECT map(list(token), list(stem)) AS m FROM stemmed), pairs AS (SELECT pair_id, {_STEMMED.format('gen')}, {_STEMMED.format('ref')} FROM plain, by_word)"""


@query(f"""WITH RECURSIVE {STEMMED_PAIRS}, {LCS}, r1 AS (SELECT * FROM (WITH {_rouge_sql('gen', 'ref', 'rouge1')})),
r2 AS (SELECT * FROM (WITH {_rouge_sql(S.bigrams('gen'), S.bigrams('ref'), 'rouge2')}))
SELECT pair_id, rouge1, rouge2, "rougeL" FROM r1 JOIN r2 USING (pair_id) JOIN rl USING (pair_id)""")
def rouge_stemmed(spark, d):
    return _rounded(R.rouge(_pairs(spark, d), "pair_id"), "rouge1", "rouge2", "rougeL")


@query(f"""WITH RECURSIVE {PAIRS}, {LCS}, r1 AS (SELECT * FROM (WITH {_rouge_sql('gen', 'ref', 'rouge1')})),
r2 AS (SELECT * FROM (WITH {_rouge_sql(S.bigrams('gen'), S.bigrams('ref'), 'rouge2')}))
SELECT pair_id, rouge1, rouge2, "rougeL" FROM r1 JOIN r2 USING (pair_id) JOIN rl USING (pair_id)""")
def rouge_plain(spark, d):
    return _rounded(R.rouge(_pairs(spark, d), "pair_id", stem=False), "rouge1", "rouge2", "rougeL")


@query(f"""WITH RECURSIVE {PAIRS}, {LCS}, r1 AS (SELECT * FROM (WITH {_rouge_sql('gen', 'ref', 'rouge1')})),
r2 AS (SELECT * FROM (WITH {_rouge_sql(S.bigrams('gen'), S.bigrams('ref'), 'rouge2')}))
SELECT 'rouge1' AS metric, round(avg(rouge1), 4) AS value FROM r1 UNION ALL SELECT 'rouge2', round(avg(rouge2), 4) FROM r2
UNION ALL SELECT 'rougeL', round(avg("rougeL"), 4) FROM rl""")
def rouge_mean_plain(spark, d):
    return R.mean_scores(_rounded(R.rouge(_pairs(spark, d), "pair_id", stem=False), "rouge1", "rouge2", "rougeL"))


@query()
def rouge_mean(spark, d):
    table_ = SU.summarize_clusters(docs(spark, d), "source", "doc_id")
    named = table_.withColumnsRenamed({"centroid_summary": "generated", "extractive_summary": "reference"})
    return R.mean_scores(R.rouge(named, "cluster_id"))


# ------------------------------------------------------------------ topic keywords, a source taken as a topic

CT = f"""t AS (SELECT source AS g, unnest({S.feature_tokens('text')}) AS term FROM documents), tf AS (SELECT g, term, count(*) AS tf FROM t GROUP BY ALL),
sz AS (SELECT g, sum(tf) AS size FROM tf GROUP BY g), us AS (SELECT term, sum(tf) AS f FROM tf GROUP BY term),
wt AS (SELECT tf.g, tf.term, tf, tf / size * ln(1 + (SELECT avg(size) FROM sz) / f) AS weight FROM tf JOIN sz ON sz.g = tf.g JOIN us ON us.term = tf.term)"""


def _class_weights(spark, d, group="source"):
    return T.class_tfidf(docs(spark, d).select(group, X.features_tokens(F.col("text")).alias("tokens")), group)


@query(f"""WITH {CT}, r AS (SELECT g, term, tf, round(weight, 9) AS weight, row_number() OVER (PARTITION BY g ORDER BY round(weight, 9) DESC, term) AS rank FROM wt)
SELECT g AS source, term, tf, round(weight, 7) AS weight, rank FROM r WHERE rank <= 10""")
def ctfidf_keywords(spark, d):
    return longs(T.keywords(_class_weights(spark, d), "source").withColumn("weight", F.round("weight", 7)))


@query("SELECT CASE WHEN n_chars > 5000 THEN -1 ELSE n_chars // 500 END AS topic, count(*) AS n FROM documents GROUP BY ALL")
def topic_sizes(spark, d):
    topic = F.when(F.col("n_chars") > 5000, -1).otherwise(F.floor(F.col("n_chars") / 500))
    return T.topic_sizes(docs(spark, d).select(topic.cast("long").alias("topic")))


@query("SELECT topic, n FROM (SELECT CASE WHEN n_chars > 5000 THEN -1 ELSE n_chars // 100 END AS topic, count(*) AS n FROM documents GROUP BY ALL) ORDER BY n DESC, topic LIMIT 12")
def topic_report_head(spark, d):
    topic = F.when(F.col("n_chars") > 5000, -1).otherwise(F.floor(F.col("n_chars") / 100))
    return T.topic_sizes(docs(spark, d).select(topic.cast("long").alias("topic"))).limit(12)


SIMILAR = f"""{CT}, nm AS (SELECT g, sqrt(sum(weight * weight)) AS n FROM wt GROUP BY g), un AS (SELECT wt.g, term, weight / n AS w FROM wt JOIN nm ON nm.g = wt.g),
pr AS (SELECT x.g AS a, y.g AS b, round(sum(x.w * y.w), 9) AS similarity FROM un x JOIN un y ON y.term = x.term AND x.g < y.g GROUP BY ALL HAVING round(sum(x.w * y.w), 9) >= 0.78)"""


@query(f"WITH {SIMILAR} SELECT a, b, round(similarity, 6) AS similarity FROM pr")
def topic_similarity(spark, d):
    return T.similar_groups(_class_weights(spark, d), "source", 0.78).withColumn("similarity", F.round("similarity", 6))


@query(f"""WITH RECURSIVE {SIMILAR}, ed AS (SELECT a, b FROM pr UNION SELECT b, a FROM pr),
reach(g, h) AS (SELECT DISTINCT source, source FROM documents UNION SELECT reach.g, ed.b FROM reach JOIN ed ON ed.a = reach.h),
mp AS (SELECT g, min(h) AS merged FROM reach GROUP BY g)
SELECT mp.merged AS source, count(*) AS n FROM documents JOIN mp ON mp.g = documents.source GROUP BY mp.merged""")
def topic_merge(spark, d):
    df = docs(spark, d).select("source")
    mapping = T.merge_map(df.distinct(), T.similar_groups(_class_weights(spark, d), "source", 0.78))
    return T.merge_topics(df, mapping, "source").groupBy("source").agg(F.count("*").alias("n"))
