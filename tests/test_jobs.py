"""Whole stages, streams and trained models, on small tables."""
import threading

import pytest
import numpy as np
from pyspark.sql import functions as F

from textsignal.operators import classify as C, embeddings as EM, ingest, lda as LDA, topics as T
from textsignal.operators.bounds import local_table
from textsignal.plans import stages
from textsignal.sources import readers, writers
from textsignal.streaming import posts as SP


@pytest.fixture(scope="module")
def corpus(spark):
    """Two classes with their own words."""
    words = {"calm": "lake tree soft quiet river moss", "storm": "thunder rain wild wind flood hail"}
    row = lambda c: F.concat_ws(" ", *[F.get(F.split(F.lit(words[c]), " "), (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(6))).cast("int"))
                                       for i in range(8)], F.concat(F.lit("n"), F.col("id") % 5))
    return spark.range(200).select(F.col("id").alias("post_id"), F.when(F.col("id") % 2 == 0, row("calm")).otherwise(row("storm")).alias("text"),
                                   F.when(F.col("id") % 2 == 0, "calm").otherwise("storm").alias("label")).persist()


def test_corpus_from_files(spark, tmp_path):
    (tmp_path / "forum.csv").write_text('post,label\n"line one\nline ""two"" u/me",anxiety\nplain,depression\n,x\n')
    for name, body in (("train", "text,label\nplain,1\nfresh **text**,0\n"), ("test", "text,label\nother,7\nlast,1\n")):
        (tmp_path / f"{name}.csv").write_text(body)
    splits = {n: str(tmp_path / f"{n}.csv") for n in ("train", "test")}
    merged = stages.build_corpus(spark, str(tmp_path / "forum.csv"), splits)
    got = {(r["text"], r["label"], r["source"]) for r in merged.collect()}
    assert got == {('line one\nline "two" u/me', "anxiety", "forum"), ("plain", "depression", "forum"),
                   ("fresh **text**", "not_stressed", "stress"), ("last", "stress", "stress")}
    assert stages.build_corpus(spark, str(tmp_path / "missing.csv"), splits).count() == 3

    posts = spark.createDataFrame(merged.toArrow(), schema=merged.schema).withColumn("post_id", F.xxhash64("text"))
    empty = lambda c: local_table(spark, {"token": ["lines"], c: ["line"]}, f"token string, {c} string")
    cleaned = stages.clean_corpus(posts, empty("lemma"), empty("pos"))
    path = stages.write_stage(cleaned, str(tmp_path / "cleaned"))
    back = readers.read_first_existing(spark, [str(tmp_path / "enriched"), path])
    row = back.filter("label = 'anxiety'").head()
    assert row["text_clean_deep"] == "line one line two" and row["text_clean_classical"] == "line one line two"
    tagged = stages.tag_corpus(stages.score_corpus(back, {"fresh": 2.0}), second={"last": "MISC"}, sample_size=3)
    assert tagged.count() == 3 and {"vader_compound", "entities", "second_entities"} <= set(tagged.columns)
    table, scores = stages.summarize_corpus(back)
    assert table.count() == 4
    assert {r["metric"]: r["value"] for r in scores.collect()} == {"rouge1": 1.0, "rouge2": .5, "rougeL": 1.0}


def test_stream_equals_batch(spark, tmp_path, corpus):
    source = corpus.select("post_id", F.concat("text", F.lit(" u/x **zoloft** 3 years ago")).alias("text"), "label", F.lit("s").alias("source"))
    source.write.parquet(str(tmp_path / "in"))
    lexicon = {"wild": -1.0, "soft": 1.5}
    query = SP.write_posts(SP.enrich(SP.read_posts(spark, str(tmp_path / "in"), max_files=1), lexicon), str(tmp_path / "out"), str(tmp_path / "ck"))
    query.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    batch = SP.enrich(source, lexicon)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.select(streamed.columns).collect())) and streamed.count() == 200


def test_bucketed_stage_needs_no_shuffle(spark, corpus):
    writers.write_bucketed(corpus, "posts_by_id", "post_id", 4)
    try:
        t = spark.table("posts_by_id")
        plan = t.groupBy("post_id").agg(F.max("text"))._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan
    finally:
        spark.sql("DROP TABLE posts_by_id")


def test_csv_sink_reads_back(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c\nd', "x\\y")], "post string, label string")
    writers.write_table(df, str(tmp_path / "t"), "csv")
    assert readers.read_csv(spark, str(tmp_path / "t"), readers.FORUM_SCHEMA).collect() == df.collect()


def test_models_are_ranked_saved_and_used(spark, tmp_path, corpus):
    scores, preds, fitted, best = C.train_and_rank(corpus, "text", "label", "post_id", trees=10, max_depth=5)
    rows = scores.collect()
    assert len(rows) == 4 and all(r["f1_weighted"] > .9 for r in rows)
    assert [r["f1_weighted"] for r in rows] == sorted((r["f1_weighted"] for r in rows), reverse=True)
    assert preds.count() == 4 * 30 and best in fitted
    C.save_model(fitted["TF-IDF + LogReg"], str(tmp_path / "m"))
    out = C.predict(C.load_model(str(tmp_path / "m")), corpus, "text", ["calm", "storm"], "post_id")
    joined = out.join(corpus.select("post_id", F.col("label").alias("y")), "post_id")
    assert joined.filter("label = y").count() > 190
    first = out.head()["ranking"]
    assert first[0]["probability"] >= first[1]["probability"] and sum(p["probability"] for p in first) == pytest.approx(1, abs=.001)


def test_models_are_fitted_side_by_side(spark, corpus):
    """Two models that wait for each other; the forest keeps the nodes of its rows between passes."""
    both = threading.Barrier(2)

    class Waiting:
        def setLabelCol(self, name):
            return self

        def fit(self, data):
            both.wait(60)
            return C.logistic_regression(170).setLabelCol("label_code").fit(data)

    scores, preds, fitted, best = C.train_and_rank(corpus, "text", "label", "post_id", models={"a": (C.BOW, 1, Waiting()), "b": (C.BOW, 1, Waiting())})
    assert best == "a" and list(fitted) == ["a", "b"] and preds.count() == 2 * 30 and scores.count() == 2
    assert C.random_forest().getCacheNodeIds()


def test_tfidf_features_have_unit_length(spark, corpus):
    from pyspark.ml.functions import vector_to_array
    model = C.fit_features(corpus, "text")
    norms = model.transform(corpus).select(F.aggregate(F.transform(vector_to_array("features"), lambda x: x * x), F.lit(0.0), lambda a, x: a + x).alias("n"))
    assert norms.filter("abs(n - 1) > 1e-9").count() == 0


def test_validation_picks_a_candidate_and_reports(spark, corpus):
    _, report, label_map, tried = C.fit_with_validation(corpus, "text", "label", "post_id")
    assert {r["class"] for r in report.collect()} == {"calm", "storm", "accuracy", "macro avg", "weighted avg"}
    assert [tuple(r) for r in label_map.collect()] == [(0, "calm"), (1, "storm")] and 1 <= tried.count() <= 4


def test_word_vectors(spark, corpus):
    tokens = corpus.select("post_id", F.split("text", " ").alias("tokens"))
    model = EM.train_word_vectors(tokens, size=16)
    words = EM.word_table(model)
    near = EM.word_neighbours(words, spark.createDataFrame([("lake",), ("absent",)], "probe string")).collect()
    known = [r for r in near if r["probe"] == "lake"]
    assert len(known) == 5 and all(r["known"] and r["neighbour"] != "lake" for r in known)
    assert [(r["known"], r["neighbour"]) for r in near if r["probe"] == "absent"] == [(False, None)]
    assert EM.word_analogy(words, ["lake", "tree"], ["rain"]).count() == 3
    assert EM.word_analogy(words, ["lake", "absent"], ["rain"]).count() == 0
    vectors = EM.document_vectors(tokens, model, "post_id").persist()
    assert vectors.count() == 200 and len(vectors.head()["embedding"]) == 16
    assigned = T.cluster_documents(vectors, "post_id", k=2, dims=3)
    assert 0 < assigned.filter("topic = -1").count() <= 25 and assigned.count() == 200
    assert T.topic_count(assigned).head()["n_topics"] == 2
    keys = T.keywords(T.class_tfidf(tokens.join(assigned.select("post_id", "topic"), "post_id"), "topic"), "topic", 4)
    info = T.topic_info(assigned, keys, corpus, "post_id", "text").collect()
    assert sum(r["count"] for r in info) == 200 and all(len(r["representation"]) == 4 for r in info)


@pytest.mark.parametrize("part_rows, block_pairs", [(512, 500_000), (7, 20)])
def test_word_vectors_factor_the_information_matrix(spark, part_rows, block_pairs):
    """With as many components as words, products of vectors are the matrix but for the sign of its directions; planted pairs are nearest."""
    rng = np.random.default_rng(5)
    texts = [(i, [f"{p}{rng.integers(2)}" if p in "ab" else f"{p}{rng.integers(6)}" for p in rng.choice(list("abcd"), 30, p=[.1, .1, .4, .4])]) for i in range(60)]
    # x and y are used in the same places, so are u and v.
    for i in range(60, 160):
        texts.append((i, ["c0", "c1", rng.choice(["x", "y"]), "c2", "c0"] if i % 2 else ["d4", "d5", rng.choice(["u", "v"]), "d3", "d4"]))
    texts = [(i, [str(t) for t in ts]) for i, ts in texts] + [(900, None), (901, []), (902, ["once"])]
    words, counts, window = sorted({t for _, ts in texts for t in ts or []} - {"once"}), {}, 5
    at = {w: i for i, w in enumerate(words)}
    m = np.zeros((len(words), len(words)))
    for _, ts in texts:
        ts = [t for t in ts or [] if t in at]
        for i in range(len(ts)):
            for d in range(1, window + 1):
                if i + d < len(ts):
                    m[at[ts[i]], at[ts[i + d]]] += (window + 1 - d) / window
                    m[at[ts[i + d]], at[ts[i]]] += (window + 1 - d) / window
    with np.errstate(divide="ignore"):
        m = np.maximum(np.log(m * m.sum() / np.outer(m.sum(0), m.sum(0))) - np.log(1.5), 0)
    value, side = np.linalg.eigh(m)
    want = side * np.abs(value) @ side.T
    df = spark.createDataFrame(texts, "id long, tokens array<string>")
    model = EM.train_word_vectors(df, size=40, shift=1.5, part_rows=part_rows, block_pairs=block_pairs)
    rows = {r.word: r.v for r in model.collect()}
    assert sorted(rows) == words
    got = np.array([rows[w] for w in words])
    assert got @ got.T == pytest.approx(want, abs=2e-3)
    near = EM.word_neighbours(EM.word_table(model), spark.createDataFrame([("x",), ("u",)], "probe string"), 1)
    assert {(r.probe, r.neighbour) for r in near.collect()} == {("x", "y"), ("u", "v")}
    documents = {r.id: r.embedding for r in EM.document_vectors(df, model, "id").collect()}
    mean = np.mean([rows[t] for t in texts[70][1] if t in rows], 0)
    assert documents[70] == pytest.approx(mean / np.linalg.norm(mean), abs=1e-5) and not any(documents[902]) and len(documents) == len(texts)


def test_word_vectors_are_asked_for_by_few_blocks(spark, monkeypatch):
    """Long vectors go to tasks in slices, so that their blocks are as large as those of short ones and few of them ask for the same word."""
    rng, kept = np.random.default_rng(3), {}
    texts = [(i, [f"w{int(w)}" for w in 600 * rng.random(40) ** 2]) for i in range(400)]
    monkeypatch.setattr(EM, "stored", lambda df, name: kept.setdefault(name, []).append(made := writers.stored(df, name)) or made)
    vectors = EM.train_word_vectors(spark.createDataFrame(texts, "id long, tokens array<string>"), size=300, block_pairs=8_000)
    words, asked = vectors.count(), kept["needed"][0].count()
    assert words > 500 and asked < 4 * words and {len(r.v) for r in vectors.select("v").collect()} == {300}


def test_own_encoder(spark, corpus):
    out = EM.encode_with(corpus, "post_id", "text", lambda: lambda texts: [[t.count("a"), t.count("i") + 1] for t in texts], 7)
    assert out.count() == 200 and sum(x * x for x in out.head()["embedding"]) == pytest.approx(1)


def test_lda_keeps_the_whole_dictionary(spark):
    df = spark.range(6).select(F.transform(F.sequence(F.lit(1), F.lit(100_500)), lambda i: i.cast("string")).alias("tokens"))
    fit = lambda **more: LDA.fit(df, topics=2, passes=1, max_df=6, **more).terms.count()
    assert fit() == 100_500 and fit(keep=7) == 7


def test_lda_reports_k_topics(spark, corpus):
    terms = LDA.fit(corpus.select(F.split("text", " ").alias("tokens")), topics=3, passes=4).topic_terms(5)
    assert terms.count() == 15
    words = T.topic_word_lists(terms).orderBy("topic").collect()
    assert [r["topic"] for r in words] == ["topic_0", "topic_1", "topic_2"] and all(len(r["words"]) == 5 for r in words)


@pytest.mark.parametrize("part_rows", [512, 7])
def test_lda_finds_planted_topics(spark, part_rows):
    """Documents of one or two of four topics with own words: each topic found holds one planted topic's words."""
    rng = np.random.default_rng(0)
    docs = []
    for i in range(240):
        first, second = rng.choice(4, 2, replace=False)
        share = rng.choice([0.0, 0.3])
        docs.append((i, [f"t{second if rng.random() < share else first}w{rng.integers(12)}" for _ in range(40)] + ["common"]))
    df = spark.createDataFrame([*docs, (900, []), (901, None), (902, ["never"])], "id long, tokens array<string>")
    model = LDA.fit(df, topics=4, passes=15, part_rows=part_rows)
    found = {}
    for r in model.topic_terms(8).collect():
        found.setdefault(r.topic, []).append(r.term[:2])
    assert {tuple(set(words)) for words in found.values()} == {("t0",), ("t1",), ("t2",), ("t3",)}
    assert "common" not in {r.term for r in model.terms.collect()} and model.alpha.max() < 0.25
    assert LDA.fit(df.limit(0), topics=2).topic_terms().count() == 0


def test_lda_numbers(spark):
    """Digamma and trigamma against differences of the log gamma function, one pass against plain variational updates."""
    import math
    x = np.array([0.01, 0.3, 1.0, 4.7, 6.0, 55.0])
    log_gamma = np.vectorize(math.lgamma)
    assert LDA.digamma(x) == pytest.approx((log_gamma(x * (1 + 1e-6)) - log_gamma(x * (1 - 1e-6))) / (2e-6 * x), rel=1e-5)
    assert LDA.trigamma(x) == pytest.approx((LDA.digamma(x * (1 + 1e-5)) - LDA.digamma(x * (1 - 1e-5))) / (2e-5 * x), rel=1e-4)
    beta, alpha, n = np.array([[.5, .1], [.2, .6], [.3, .3]]), np.array([.4, .7]), np.array([2., 1., 3., 1.])
    gamma, entries = LDA.fit_documents(np.array([0, 3, 4]), np.array([0, 1, 2, 1]), n, beta, alpha)
    assert gamma == pytest.approx(alpha + np.add.reduceat(entries, [0, 3], 0), abs=0.02) and entries.sum(1) == pytest.approx(n)


def test_query_blocks_are_held_one_at_a_time(spark, monkeypatch):
    from textsignal import config
    from textsignal.operators import search as SE
    vectors = spark.range(60).select(F.col("id").alias("idx"), F.array(F.sin("id"), F.cos("id")).alias("embedding"), F.lit("x").alias("label"))
    queries = vectors.filter("idx % 3 = 0").select(F.col("idx").alias("query_id"), "embedding")
    rows_of = lambda df: sorted(map(str, df.collect()))
    whole = rows_of(SE.dense_top_k(queries, vectors, 3))
    monkeypatch.setattr(config, "QUERY_BLOCK", 8)
    live, most, read = set(), [], SE._over_blocks

    def watched(blocks, scan):
        def seen(table):
            hits, shared = scan(table)
            live.add(shared)
            most.append(len(live))
            release = shared.unpersist
            shared.unpersist = lambda: (live.discard(shared), release())
            return hits, shared
        return read(blocks, seen)
    monkeypatch.setattr(SE, "_over_blocks", watched)
    assert rows_of(SE.dense_top_k(queries, vectors, 3)) == whole
    assert len(most) > 2 and max(most) <= 2


def test_cell_search_without_queries(spark):
    from textsignal.operators import search as SE
    cells = spark.createDataFrame([(1, [1.0, 0.0], 0)], "idx long, embedding array<float>, cell int")
    none = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert SE.ivf_top_k(none, cells, np.zeros((1, 2))).count() == 0


def test_too_large_samples_and_reports_are_refused(spark):
    from textsignal.operators.rows import sample_n
    df = spark.range(5)
    assert sample_n(df, 5, "id").count() == 5
    with pytest.raises(ValueError):
        sample_n(df, 6, "id").count()
    with pytest.raises(ValueError):
        writers.map_json(df.withColumn("v", F.lit(1)), "id", "v", max_rows=4)


def test_partitions_are_written_by_few_tasks(spark, tmp_path):
    """Each folder gets at most as many files as there are salts, though every task holds rows of every folder."""
    df = spark.range(0, 4000, 1, 16).withColumn("cell", (F.col("id") % 3).cast("int"))
    writers.write_table(df, str(tmp_path / "cells"), partition_by="cell", salts=2)
    files = [len(list(p.glob("part-*"))) for p in (tmp_path / "cells").glob("cell=*")]
    assert len(files) == 3 and max(files) <= 2
    assert spark.read.parquet(str(tmp_path / "cells")).select("id").distinct().count() == 4000


def test_first_copies_stay(spark):
    rows = [(0, 1, "a"), (0, 2, None), (1, 1, "a"), (1, 3, None), (0, 4, "b"), (1, None, "c"), (1, 9, "c")]
    df = spark.createDataFrame(rows, "source_rank int, post_id long, text string")
    kept = {(r.source_rank, r.post_id, r.text) for r in ingest.keep_first_copy(df).collect()}
    assert {(0, 1, "a"), (0, 2, None), (0, 4, "b")} <= kept and (1, 1, "a") not in kept and (1, 3, None) not in kept and len([k for k in kept if k[2] == "c"]) >= 1
