"""Registered queries: cleaning, tokens, sentiment, entities."""
from pyspark.sql import functions as F

from textsignal import config, vocab
from textsignal.functions import text as X
from textsignal.operators import entities as E, features as FE, sentiment, tokens as TK
from textsignal.operators.bounds import bind, keep_bound, local_table
from textsignal.plans import inputs as I, sql as S
from textsignal.plans.inputs import joined, longs, table
from textsignal.sources import readers, writers

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


def word_table(spark, mapping, value):
    return local_table(spark, {"token": list(mapping), value: list(mapping.values())}, f"token string, {value} string")


# ------------------------------------------------------------------ cleaning

@query(f"SELECT doc_id, {S.noise(I.SQL_NOISY)} AS text FROM documents")
def noise_removal(spark, d):
    return docs(spark, d).select("doc_id", X.remove_noise(I.noisy_text()).alias("text"))


@query(f"SELECT doc_id, {S.deep(I.SQL_NOISY)} AS text FROM documents")
def clean_deep(spark, d):
    return docs(spark, d).select("doc_id", X.clean_deep(I.noisy_text()).alias("text"))


@query(f"SELECT page_id, {S.deep('html')} AS text FROM pages")
def clean_html_entities(spark, d):
    return table(spark, d, "pages").select("page_id", X.clean_deep(F.col("html")).alias("text"))


BLANKS = ["> * _ ~ `", "https://a.b", "&amp; ", "r/x u/y", "kept "]


@query(f"""WITH t AS (SELECT doc_id, {S.deep('CASE WHEN doc_id % 7 < 5 THEN ' + I.sql_choose(BLANKS, 'doc_id') + ' ELSE text END')} AS c
FROM documents) SELECT doc_id, c AS text_clean_deep FROM t WHERE length({S.strip('c')}) > 0""")
def blank_posts_dropped(spark, d):
    from textsignal.operators.ingest import clean_posts
    raw = F.when(F.col("doc_id") % 7 < 5, I.choose(BLANKS, "doc_id")).otherwise(F.col("text"))
    return clean_posts(docs(spark, d).select("doc_id", raw.alias("text"))).select("doc_id", "text_clean_deep")


CLEAN_TOKENS = f"SELECT doc_id, {S.word_tokens(S.deep(I.SQL_NOISY))} AS tk FROM documents"
QUOTED = "concat(text, ' I cannot say “gonna” or ‘wanna go’ lemme gotta gimme cannot')"


def _word_tokens(spark, d):
    return docs(spark, d).select("doc_id", X.tokenize(X.clean_deep(I.noisy_text())).alias("tokens"))


@query(f"""WITH t AS (SELECT doc_id, {S.tokens(S.deep(I.SQL_NOISY))} AS tk FROM documents)
SELECT doc_id, unnest(range(len(tk))) AS pos, unnest(tk) AS token FROM t""")
def tokens_exploded(spark, d):
    tokens = docs(spark, d).select("doc_id", X.tokenize(X.clean_deep(I.noisy_text()), "whitespace").alias("tokens"))
    return longs(TK.explode_tokens(tokens, "doc_id"))


@query(f"""WITH t AS (SELECT doc_id, {S.word_tokens(S.deep(QUOTED))} AS tk FROM documents)
SELECT doc_id, array_to_string(tk, '|') AS tokens, len(tk) AS n FROM t""")
def word_tokens(spark, d):
    text = F.concat("text", F.lit(" I cannot say “gonna” or ‘wanna go’ lemme gotta gimme cannot"))
    t = docs(spark, d).select("doc_id", X.tokenize(X.clean_deep(text)).alias("t"))
    return longs(t.select("doc_id", joined("t").alias("tokens"), F.size("t").alias("n")))


@query(f"WITH t AS ({CLEAN_TOKENS}) SELECT doc_id, array_to_string({S.kept('tk')}, '|') AS tokens FROM t")
def stopwords_removed(spark, d):
    return _word_tokens(spark, d).select("doc_id", joined(X.remove_stopwords(F.col("tokens"))).alias("tokens"))


@query(f"""WITH t AS ({CLEAN_TOKENS}), e AS (SELECT doc_id, unnest(tk) AS token FROM t)
SELECT token, count(*) AS n FROM e WHERE token NOT IN {S.in_list(vocab.STOPWORDS)} GROUP BY token""")
def stopword_anti_join(spark, d):
    words = local_table(spark, {"token": vocab.STOPWORDS}, "token string")
    kept = TK.drop_listed(TK.explode_tokens(_word_tokens(spark, d), "doc_id"), words)
    return kept.groupBy("token").agg(F.count("*").alias("n"))


LEMMA_SQL = f"""t AS ({CLEAN_TOKENS}), k AS (SELECT doc_id, {S.kept('tk')} AS tk FROM t),
e AS (SELECT doc_id, unnest(range(len(tk))) AS pos, unnest(tk) AS token FROM k),
l AS (SELECT doc_id, pos, coalesce(x.lemma, e.token) AS lemma FROM e
      LEFT JOIN {S.values(list(I.LEMMAS.items()))} x(token, lemma) ON x.token = e.token),
g AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS s FROM l WHERE lemma NOT IN {S.in_list(vocab.STOPWORDS)} GROUP BY doc_id)"""


@query(f"WITH {LEMMA_SQL} SELECT d.doc_id, coalesce(g.s, '') AS text_clean_classical FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id")
def clean_classical(spark, d):
    kept = _word_tokens(spark, d).withColumn("tokens", X.remove_stopwords(F.col("tokens")))
    lemmas = TK.lemmatize(kept, "doc_id", word_table(spark, I.LEMMAS, "lemma"))
    return lemmas.select("doc_id", F.array_join("tokens", " ").alias("text_clean_classical"))


@query(f"WITH {LEMMA_SQL} SELECT lemma, count(*) AS n FROM l GROUP BY lemma")
def lemma_join(spark, d):
    kept = _word_tokens(spark, d).withColumn("tokens", X.remove_stopwords(F.col("tokens")))
    found = TK.lemmas(kept, word_table(spark, I.LEMMAS, "lemma"))
    return found.select(F.explode("lemmas").alias("lemma")).groupBy("lemma").agg(F.count("*").alias("n"))


_SHAPES = [("^[0-9]+$", "CD"), *((f"({'|'.join(e)})$", v) for v, e in vocab.SUFFIX_TAGS), ("[^s]s$", "NNS")]
_CASES = "".join(f" WHEN regexp_matches(e.token, {S.lit(p)}) THEN {S.lit(v)}" for p, v in _SHAPES)


@query(f"""WITH t AS ({CLEAN_TOKENS}), e AS (SELECT doc_id, unnest(range(len(tk))) AS pos, unnest(tk) AS token FROM t),
p AS (SELECT doc_id, pos, e.token, CASE WHEN x.pos_tag IS NOT NULL THEN x.pos_tag
      WHEN e.token IN {S.in_list(vocab.STOPWORDS)} THEN '{vocab.FUNCTION_WORD_TAG}'{_CASES} ELSE '{vocab.DEFAULT_TAG}' END AS tag
      FROM e LEFT JOIN {S.values(list(I.TAGS.items()))} x(token, pos_tag) ON x.token = e.token),
g AS (SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS s FROM p WHERE tag LIKE 'JJ%' OR tag LIKE 'NN%' GROUP BY doc_id)
SELECT d.doc_id, coalesce(g.s, '') AS tokens_adj_noun FROM documents d LEFT JOIN g ON g.doc_id = d.doc_id""")
def adj_noun_tokens(spark, d):
    out = TK.adjectives_and_nouns(_word_tokens(spark, d), "doc_id", word_table(spark, I.TAGS, "pos"))
    return out.select("doc_id", F.array_join("tokens", " ").alias("tokens_adj_noun"))


@query(SQL["adj_noun_tokens"])
def adj_noun_tokens_in_row(spark, d):
    kept = X.keep_adjectives_and_nouns(F.col("tokens"), I.TAGS)
    return bind(_word_tokens(spark, d), _kept=kept).select("doc_id", F.array_join("_kept", " ").alias("tokens_adj_noun"))


@query(f"""WITH c AS (SELECT unnest({S.tokens(S.deep(I.SQL_NOISY))}) AS token FROM documents), v AS (SELECT token, count(*) AS n FROM c GROUP BY token), {S.stems('v')}
SELECT stem, sum(n)::BIGINT AS n, count(*) AS n_forms FROM v JOIN stemmed USING (token) GROUP BY stem""")
def stem_counts(spark, d):
    return TK.stem_counts(TK.explode_tokens(_word_tokens(spark, d), "doc_id"))


@query(f"""WITH t AS (SELECT doc_id, {S.sentences('text')} AS s FROM documents)
SELECT doc_id, unnest(range(len(s))) AS sent, unnest(s) AS sentence FROM t""")
def sentence_split(spark, d):
    return longs(docs(spark, d).select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("sent", "sentence")))


# ------------------------------------------------------------------ sentiment

_N, _B = vocab.NEGATION_FACTOR, vocab.BOOST
_boost = lambda w: f"CASE WHEN {w} IN {S.in_list(vocab.BOOSTERS)} THEN {_B}::DOUBLE WHEN {w} IN {S.in_list(vocab.DAMPENERS)} THEN -{_B}::DOUBLE ELSE 0::DOUBLE END"
_neg = lambda w: f"coalesce({w} IN {S.in_list(vocab.NEGATIONS)}, false)"
_eq = lambda w, *v: f"coalesce({w} IN {S.in_list(v)}, false)"


def _sql_step(d, prev, emphatic="false", sure="false"):
    w, damp = f"p{d}", vocab.DISTANCE_DAMPING[d]
    push = f"({_boost(w)}) * {damp}::DOUBLE"
    return (f"CASE WHEN {w} IS NULL OR x{d} IS NOT NULL THEN {prev} ELSE ({prev} + CASE WHEN {prev} < 0 THEN -1 ELSE 1 END * {push}) "
            f"* CASE WHEN {emphatic} THEN {vocab.EMPHATIC_NEVER}::DOUBLE WHEN {sure} THEN 1::DOUBLE WHEN {_neg(w)} THEN {_N}::DOUBLE ELSE 1::DOUBLE END END")


PHRASES = ["token || ' ' || nt || ' ' || nt2", "token || ' ' || nt", "p1 || ' ' || token", "p2 || ' ' || p1 || ' ' || token",
           "p2 || ' ' || p1", "p3 || ' ' || p2 || ' ' || p1", "p3 || ' ' || p2"]
_idiom = lambda p: f"CASE {p} " + " ".join(f"WHEN {S.lit(k)} THEN {v}::DOUBLE" for k, v in vocab.IDIOMS.items()) + " END"
_pair = lambda p: f"coalesce({p} IN {S.in_list(vocab.DAMPENER_PAIRS)}, false)"
SENTIMENT_SQL = f"""
t AS (SELECT doc_id, {S.tokens(S.deep(I.SQL_MOODY))} AS tk FROM documents),
e AS (SELECT doc_id, unnest(range(len(tk))) AS pos, unnest(tk) AS token FROM t),
j AS (SELECT e.doc_id, e.pos, e.token, l.v FROM e LEFT JOIN {S.values(list(I.LEXICON.items()))} l(token, v) ON l.token = e.token),
w AS (SELECT *, min(CASE WHEN token = 'but' THEN pos END) OVER (PARTITION BY doc_id) AS b,
  lead(token) OVER n AS nt, lead(token, 2) OVER n AS nt2, lead(v) OVER n AS nv, lag(token, 1) OVER n AS p1, lag(token, 2) OVER n AS p2, lag(token, 3) OVER n AS p3,
  lag(v, 1) OVER n AS x1, lag(v, 2) OVER n AS x2, lag(v, 3) OVER n AS x3 FROM j WINDOW n AS (PARTITION BY doc_id ORDER BY pos)),
s0 AS (SELECT *, CASE WHEN {_eq('p1', 'no')} OR {_eq('p2', 'no')} OR ({_eq('p3', 'no')} AND {_eq('p1', 'or', 'nor')}) THEN v * {_N}::DOUBLE
  WHEN token = 'no' AND nv IS NOT NULL THEN 0::DOUBLE ELSE v END AS v0 FROM w),
s1 AS (SELECT *, {_sql_step(1, 'v0')} AS v1 FROM s0),
s2 AS (SELECT *, {_sql_step(2, 'v1', _eq('p2', 'never') + ' AND ' + _eq('p1', 'so', 'this'),
                            _eq('p2', 'without') + ' AND ' + _eq('p1', 'doubt'))} AS v2 FROM s1),
s3 AS (SELECT *, {_sql_step(3, 'v2', '(' + _eq('p3', 'never') + ' AND ' + _eq('p2', 'so', 'this') + ') OR ' + _eq('p1', 'so', 'this'),
                            _eq('p3', 'without') + ' AND (' + _eq('p2', 'doubt') + ' OR ' + _eq('p1', 'doubt') + ')')} AS v3 FROM s2),
s3i AS (SELECT * EXCLUDE (v3), CASE WHEN p3 IS NULL OR x3 IS NOT NULL THEN v3 ELSE coalesce({", ".join(map(_idiom, PHRASES))}, v3)
    - CASE WHEN {_pair("p3 || ' ' || p2")} THEN {_B}::DOUBLE ELSE 0::DOUBLE END
    - CASE WHEN {_pair("p2 || ' ' || p1")} THEN {_B}::DOUBLE ELSE 0::DOUBLE END END AS v3 FROM s3),
s4 AS (SELECT doc_id, token, CASE WHEN v IS NOT NULL AND token NOT IN {S.in_list(vocab.BOOSTERS + vocab.DAMPENERS)}
    AND NOT (token = 'kind' AND {_eq('nt', 'of')})
  THEN v3 * CASE WHEN {_eq('p1', 'least')} AND x1 IS NULL AND NOT {_eq('p2', 'at', 'very')} THEN {_N}::DOUBLE ELSE 1::DOUBLE END
    * CASE WHEN b IS NULL OR pos = b THEN 1::DOUBLE WHEN pos < b THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END
  ELSE 0::DOUBLE END AS f FROM s3i),
a AS (SELECT doc_id, sum(f) AS s, coalesce(sum(f + 1) FILTER (f > 0), 0) AS p, coalesce(-sum(f - 1) FILTER (f < 0), 0) AS g,
  count(*) FILTER (f = 0) AS z FROM s4 GROUP BY doc_id),
scored AS (SELECT d.doc_id, coalesce(round(s / sqrt(s * s + 15), 4), 0) AS vader_compound, coalesce(round(p / (p + g + z), 3), 0) AS vader_pos,
  coalesce(round(g / (p + g + z), 3), 0) AS vader_neg, coalesce(round(z / (p + g + z), 3), 0) AS vader_neu
  FROM documents d LEFT JOIN a ON a.doc_id = d.doc_id)"""
CLASS_SQL = "CASE WHEN vader_compound >= 0.05 THEN 'positive' WHEN vader_compound <= -0.05 THEN 'negative' ELSE 'neutral' END"


def _moody(spark, d):
    return bind(docs(spark, d), text_clean_deep=X.clean_deep(I.moody_text())).select("doc_id", "text_clean_deep")


def _scored(spark, d):
    return sentiment.score(_moody(spark, d), I.LEXICON)


@query(f"WITH {SENTIMENT_SQL} SELECT *, {CLASS_SQL} AS vader_sentiment FROM scored")
def sentiment_scores(spark, d):
    return _scored(spark, d).drop("text_clean_deep")


@query(f"WITH {SENTIMENT_SQL} SELECT *, {CLASS_SQL} AS vader_sentiment FROM scored")
def sentiment_scores_by_join(spark, d):
    lexicon = local_table(spark, {"token": list(I.LEXICON), "valence": list(I.LEXICON.values())}, "token string, valence double")
    return sentiment.score_by_join(_moody(spark, d), "doc_id", lexicon)


@query(f"WITH {SENTIMENT_SQL} SELECT *, {CLASS_SQL} AS vader_sentiment FROM scored")
def scored_table_round_trip(spark, d):
    """The scored table, written by its stage and read back where an enriched table is preferred to the plain one."""
    from textsignal.plans import stages
    path = writers.scratch_dir(spark, "scored")
    stages.write_stage(stages.score_corpus(_moody(spark, d), I.LEXICON), path)
    return readers.read_first_existing(spark, [path, f"{d}/documents.parquet"]).drop("text_clean_deep")


@query(f"WITH {SENTIMENT_SQL} SELECT {CLASS_SQL} AS vader_sentiment, count(*) AS n FROM scored GROUP BY ALL")
def sentiment_label_counts(spark, d):
    return _scored(spark, d).groupBy("vader_sentiment").agg(F.count("*").alias("n"))


@query(f"""WITH {SENTIMENT_SQL}, r AS (SELECT min(vader_compound) AS lo, max(vader_compound) AS hi FROM scored)
SELECT CASE WHEN lo = hi THEN 1 ELSE least(floor((vader_compound - lo) * 50 / (hi - lo)) + 1, 50) END::BIGINT AS bin, count(*) AS n
FROM scored, r GROUP BY ALL""")
def sentiment_histogram(spark, d):
    return longs(FE.histogram(_scored(spark, d).select("vader_compound"), "vader_compound"))


# ------------------------------------------------------------------ entities

def _entity_sql(phrases, chars, max_words=3):
    body = S.deep(I.SQL_CLINICAL)
    body = f"substring({body}, 1, {chars})" if chars else body
    grams = " UNION ALL ".join(
        f"SELECT doc_id, i - 1 AS start, {n} AS n_words, array_to_string(tk[i:i + {n - 1}], ' ') AS phrase "
        f"FROM (SELECT doc_id, tk, unnest(range(1, len(tk) - {n} + 2)) AS i FROM t)" for n in range(1, max_words + 1))
    rows = S.values(list(phrases.items()))
    return f"""t AS (SELECT doc_id, {S.tokens(body)} AS tk FROM documents), grams AS ({grams}),
c AS (SELECT doc_id, list([{{'start': start, 'n_words': n_words, 'phrase': g.phrase, 'label': z.label}}] ORDER BY n_words DESC, start) AS cs
  FROM grams g JOIN {rows} z(phrase, label) ON z.phrase = g.phrase GROUP BY doc_id),
ents AS (SELECT doc_id, unnest(list_reduce(cs, lambda acc, x: CASE WHEN len(list_filter(acc, lambda a:
  a.start < x[1].start + x[1].n_words AND x[1].start < a.start + a.n_words)) > 0 THEN acc ELSE list_concat(acc, x) END)) AS e FROM c),
entities AS (SELECT doc_id, e.start::BIGINT AS start, e.n_words::BIGINT AS n_words, e.phrase AS phrase, e.label AS label FROM ents)"""


ENTITY_ALL = _entity_sql(vocab.gazetteer(), None)
TEMPORAL_SQL = "list_concat(list_concat({0}, {1}), {2})"


def _clinical(spark, d):
    return bind(docs(spark, d), text_clean_deep=X.clean_deep(I.clinical_text())).select("doc_id", "text_clean_deep")


def _entity_rows(df):
    return longs(df.select("doc_id", F.inline_outer("entities")).filter(F.col("phrase").isNotNull()))


@query(f"WITH {ENTITY_ALL} SELECT * FROM entities")
def phrase_entities(spark, d):
    return _entity_rows(E.with_phrases(_clinical(spark, d)))


@query(f"WITH {ENTITY_ALL} SELECT * FROM entities")
def phrase_entities_whole_text(spark, d):
    return _entity_rows(E.with_phrases(_clinical(spark, d)))


@query(f"WITH {ENTITY_ALL} SELECT * FROM entities")
def phrase_entities_by_join(spark, d):
    g = local_table(spark, E.gazetteer_rows(vocab.gazetteer()), "phrase string, label string, n_words int")
    return longs(E.phrases_by_join(_clinical(spark, d), "doc_id", g, 3))


@query(f"WITH {ENTITY_ALL} SELECT doc_id, start, n_words, upper(phrase) AS phrase, label FROM entities")
def phrase_entities_mixed_case(spark, d):
    """Upper-case text: the same phrases, as they are written."""
    shouted = _clinical(spark, d).withColumn("text_clean_deep", F.upper("text_clean_deep"))
    return _entity_rows(E.with_phrases(shouted))


@query(f"WITH {ENTITY_ALL} SELECT phrase, n_words, count(*) AS n FROM entities WHERE phrase LIKE '%anxiety%' OR phrase LIKE '%bipolar%' GROUP BY ALL")
def nested_phrase_resolution(spark, d):
    found = _entity_rows(E.with_phrases(_clinical(spark, d)))
    return (found.filter(F.col("phrase").contains("anxiety") | F.col("phrase").contains("bipolar"))
            .groupBy("phrase", "n_words").agg(F.count("*").alias("n")))


_TIME = "list_concat(list_concat({}), {})".format(
    ", ".join(f"regexp_extract_all(c, {S.lit('(?i)' + p)})" for p in X.TEMPORAL_PATTERNS[:2]),
    f"regexp_extract_all(c, {S.lit('(?i)' + X.TEMPORAL_PATTERNS[2])})")


@query(f"""WITH t AS (SELECT doc_id, {S.deep(I.SQL_CLINICAL)} AS c FROM documents)
SELECT doc_id, array_to_string({_TIME}, '|') AS times FROM t WHERE len({_TIME}) > 0""")
def temporal_entities(spark, d):
    times = keep_bound(_clinical(spark, d), "t", X.temporal_expressions(F.col("text_clean_deep")), lambda t: F.size(t) > 0)
    return times.select("doc_id", joined("t").alias("times"))


@query(f"""WITH {ENTITY_ALL}, x AS (SELECT doc_id, {S.deep(I.SQL_CLINICAL)} AS c FROM documents),
m AS (SELECT doc_id, string_agg(phrase, '|' ORDER BY start) FILTER (label = 'MEDICATION') AS medication,
  string_agg(phrase, '|' ORDER BY start) FILTER (label = 'DIAGNOSIS') AS diagnosis FROM entities GROUP BY doc_id)
SELECT x.doc_id, medication, diagnosis, CASE WHEN len({_TIME}) > 0 THEN array_to_string({_TIME}, '|') END AS temporal
FROM x LEFT JOIN m ON m.doc_id = x.doc_id""")
def entity_json(spark, d):
    """Through the JSON column and back."""
    tagged = E.extract(_clinical(spark, d)).select("doc_id", E.entity_json(F.col("entities")).alias("json"))
    e = tagged.select("doc_id", E.parse_entity_json(F.col("json")).alias("e"))
    return e.select("doc_id", *[joined(F.col("e")[k]).alias(k.lower()) for k in ("MEDICATION", "DIAGNOSIS", "TEMPORAL")])


def _frequencies(spark, d, label, name):
    return E.mention_counts(E.extract(_clinical(spark, d)), label, name=name)


@query(f"WITH {ENTITY_ALL} SELECT lower(phrase) AS medication, count(*) AS count FROM entities WHERE label = 'MEDICATION' GROUP BY ALL")
def medication_frequencies(spark, d):
    return _frequencies(spark, d, "MEDICATION", "medication")


@query(f"WITH {ENTITY_ALL} SELECT lower(phrase) AS diagnosis, count(*) AS count FROM entities WHERE label = 'DIAGNOSIS' GROUP BY ALL")
def diagnosis_frequencies(spark, d):
    return _frequencies(spark, d, "DIAGNOSIS", "diagnosis")


@query(f"""WITH {ENTITY_ALL} SELECT lower(phrase) AS diagnosis, count(*) AS count FROM entities WHERE label = 'DIAGNOSIS'
GROUP BY ALL ORDER BY count DESC, diagnosis LIMIT 15""")
def top_diagnoses(spark, d):
    return _frequencies(spark, d, "DIAGNOSIS", "diagnosis").limit(15)


@query(f"WITH {_entity_sql(I.NAMES, None)} SELECT label, phrase, count(*) AS n FROM entities GROUP BY ALL")
def gazetteer_second_tagger(spark, d):
    found = E.extract_second(_clinical(spark, d), I.NAMES)
    return (found.select(F.explode("second_entities").alias("label", "phrases")).select("label", F.explode("phrases").alias("phrase"))
            .groupBy("label", "phrase").agg(F.count("*").alias("n")))


@query(f"""WITH {ENTITY_ALL}, s AS (SELECT doc_id FROM documents ORDER BY md5('42-' || doc_id), doc_id LIMIT 2000)
SELECT label, count(*) AS n FROM entities WHERE doc_id IN (SELECT doc_id FROM s) GROUP BY label""")
def entities_of_sample(spark, d):
    from textsignal.operators.rows import sample_n
    picked = sample_n(docs(spark, d), min(2000, docs(spark, d).count()), "doc_id").select("doc_id", X.clean_deep(I.clinical_text()).alias("text_clean_deep"))
    return _entity_rows(E.with_phrases(picked)).groupBy("label").agg(F.count("*").alias("n"))
