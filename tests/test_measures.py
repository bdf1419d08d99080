import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textsignal.operators import codes as CO, features as FE, keyword as K, metrics as M, rouge as R, search as SE, splits as SP, summarize as SU, topics as T
from textsignal.plans import queries_search as QS


def test_tfidf_literal(spark):
    df = spark.createDataFrame([(1, "bad day bad"), (2, "good day"), (3, "good")], "id long, text string")
    out = {(r["id"], r["term"]): r["weight"] for r in FE.tfidf(FE.with_terms(df, "text"), "id").collect()}
    assert out == pytest.approx({(1, "bad"): .934702, (1, "day"): .355432, (2, "good"): .707107, (2, "day"): .707107, (3, "good"): 1}, abs=1e-6)


def test_tfidf_moves_the_text_once(spark):
    df = spark.createDataFrame([(1, "bad day bad"), (2, "good day")], "id long, text string")
    out = FE.tfidf(FE.with_terms(df, "text", 2), "id")
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_vocabulary_cut_and_pruning(spark):
    df = spark.createDataFrame([(i, ["x"] + (["y"] if i < 6 else []) + [f"r{i}"]) for i in range(12)], "id long, terms array<string>")
    counts = FE.corpus_counts(df)
    assert [r["term"] for r in FE.top_terms(counts, 2).collect()] == ["x", "y"]
    assert [r["term"] for r in FE.prune_terms(counts, FE.document_count(df)).collect()] == ["y"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0.5, 1, 10)], "v double")
    assert {(r["bin"], r["n"]) for r in FE.histogram(df, "v", 10).collect()} == {(1, 2), (2, 1), (10, 1)}
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [tuple(r) for r in FE.histogram(same, "v").collect()] == [(1, 2)]


def test_report_literal(spark):
    df = spark.createDataFrame(list(zip("aaabbc", "aabbca")), "y_true string, y_pred string")
    rows = {r["class"]: r for r in M.report(df).collect()}
    assert rows["a"]["f1"] == pytest.approx(.666667, abs=1e-6) and rows["b"]["f1"] == .5 and rows["c"]["f1"] == 0
    assert rows["accuracy"]["f1"] == .5 and rows["weighted avg"]["f1"] == pytest.approx(.5)
    assert rows["macro avg"]["f1"] == pytest.approx(.388889, abs=1e-6)
    assert {(r["y_true"], r["y_pred"]): r["n"] for r in M.confusion_long(df).collect()}[("c", "c")] == 0


def test_best_model_tie_goes_to_the_first(spark):
    df = spark.createDataFrame([("b", 0, 0.5), ("a", 1, 0.5), ("c", 2, 0.1)], "model string, position int, f1_weighted double")
    assert M.best_model(df).head()["model"] == "b"


def test_stratified_split_is_exact_on_a_hot_class(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 < 2, "hot").when(F.col("id") % 30 == 2, "rare").otherwise("mid").alias("label"))
    out = SP.stratified_split(df, "label", "id", [("test", .15), ("val", .15)])
    counts = {(r["label"], r["split"]): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for label, n in (("hot", 2000), ("mid", 900), ("rare", 100)):
        assert counts[label, "test"] == round(.15 * n) and counts[label, "val"] == round(.3 * n) - round(.15 * n)
    assert sum(counts.values()) == 3000 and out.select("id").distinct().count() == 3000


def test_label_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "label string")
    assert [tuple(r) for r in SP.label_codes(df, "label").orderBy("code").collect()] == [("a", 0), ("b", 1), ("c", 2)]


DOCS = ["sleep problems and medication", "sleep is good", "medication helps sleep sleep", "family and work"]


@pytest.mark.parametrize("query, scores", [
    ("sleep medication", [.110572, .125765, .160734, 0]), ("sleep sleep", [.221144, .25153, .321468, 0]), ("nothing", [0, 0, 0, 0])])
def test_bm25_literal(spark, query, scores):
    docs = spark.createDataFrame(list(enumerate(DOCS)), "idx long, text string")
    hits = SE.bm25_top_k(spark.createDataFrame([(7, query)], "query_id long, text string"), docs)
    assert {r["idx"]: r["score"] for r in hits.collect()} == pytest.approx(dict(enumerate(scores)), abs=1e-6)


def plain_bm25(docs, asked, k, k1=1.5, b=.75, epsilon=.25):
    words = {i: t.lower().split() for i, t in docs}
    df = Counter(t for ws in words.values() for t in set(ws))
    idf = {t: math.log(len(docs) - n + .5) - math.log(n + .5) for t, n in df.items()}
    low = epsilon * sum(idf.values()) / max(1, len(idf))
    mean = sum(map(len, words.values())) / len(docs)
    out = []
    for q, text in asked:
        score = lambda ws: sum((idf[t] if idf[t] >= 0 else low) * ws.count(t) * (k1 + 1) / (ws.count(t) + k1 * (1 - b + b * len(ws) / mean)) for t in text.lower().split() if t in ws)
        best = sorted((-round(score(ws), 9), i) for i, ws in words.items())[:k]
        out += [(q, i, rank) for rank, (_, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("shard, visitors, words", [(8_192, 4_096, 40), (16, 3, 40), (16, 3, 3), (5, 100, 400)])
def test_keyword_index_equals_scoring_everything(spark, monkeypatch, shard, visitors, words):
    """Over many shards and parts, with ties, empty documents, common words (weights below 0 where there are only few words), queries without a match."""
    monkeypatch.setattr("textsignal.config.TERM_BLOCK", visitors)
    rng = np.random.default_rng(shard + words)
    pick = lambda n: " ".join(f"w{int(x * x * words)}" for x in rng.random(n))
    docs = [(int(i) * 3 - 100, pick(rng.integers(0, 12))) for i in rng.permutation(200)]
    asked = [(i, pick(rng.integers(0, 6))) for i in range(40)] + [(90, "none here"), (91, "w0 w0 w0"), (92, "")]
    index = K.KeywordIndex.build(spark.createDataFrame(docs, "idx long, text string").repartition(7), shard_docs=shard)
    for k in (1, 10, 300):
        hits = K.search(spark.createDataFrame(asked, "query_id long, text string"), index, k)
        assert sorted((r.query_id, r.idx, r["rank"]) for r in hits.collect()) == plain_bm25(docs, asked, k)


def test_keyword_index_is_read_back(spark, tmp_path):
    docs = spark.createDataFrame([*enumerate(DOCS), (9, None), (None, "sleep")], "idx long, text string")
    K.KeywordIndex.build(docs, str(tmp_path / "index"))
    index = K.KeywordIndex.load(spark, str(tmp_path / "index"))
    assert index.stats["n_docs"] == 4 and {r.term: r.df for r in index.terms.collect()}["sleep"] == 3
    asked = spark.createDataFrame([(7, "sleep medication")], "query_id long, text string")
    assert [r.idx for r in K.search(asked, index, 2).orderBy("rank").collect()] == [2, 1]
    none = docs.filter("idx > 100")
    assert K.search(asked, K.KeywordIndex.build(none)).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(400, 8))
    m[50] = m[51] = m[52]
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v], str(i % 4)) for i, v in enumerate(m)]
    return m, spark.createDataFrame(rows, "idx long, embedding array<double>, label string").repartition(5)


def queries_of(spark, m, ids):
    return spark.createDataFrame([(i, [float(x) for x in m[i]]) for i in ids], "query_id long, embedding array<double>")


def brute(m, q, k, keep=lambda i: True):
    order = sorted((-round(float(m[q] @ m[i]), 9), i) for i in range(len(m)) if keep(i))
    return [i for _, i in order[:k]]


def ranked(hits, q):
    return [r["idx"] for r in hits.filter(F.col("query_id") == q).orderBy("rank").collect()]


def test_dense_top_k_is_exact_with_ties(spark, vectors):
    m, df = vectors
    hits = SE.dense_top_k(queries_of(spark, m, [0, 50, 399]), df, 10)
    for q in (0, 50, 399):
        assert ranked(hits, q) == brute(m, q, 10)


def test_dense_filter_modes(spark, vectors):
    m, df = vectors
    q = queries_of(spark, m, [3])
    assert ranked(SE.dense_top_k(q, df, 10, "2"), 3) == brute(m, 3, 10, lambda i: i % 4 == 2)
    over = ranked(SE.dense_top_k(q, df, 10, "2", mode="overfetch"), 3)
    assert over == [i for i in brute(m, 3, 30) if i % 4 == 2][:10]
    few = df.filter("label <> '2' OR idx < 10")
    assert len(ranked(SE.dense_top_k(q, few, 10, "2"), 3)) == 2
    assert SE.dense_top_k(q.limit(0), df).count() == 0


def test_query_blocks_equal_one_pass(spark, vectors, monkeypatch):
    m, df = vectors
    q = queries_of(spark, m, range(40))
    whole = sorted(map(tuple, SE.dense_top_k(q, df, 5).collect()))
    monkeypatch.setattr("textsignal.config.QUERY_BLOCK", 7)
    assert sorted(map(tuple, SE.dense_top_k(q, df, 5).collect())) == whole


def test_ivf_default_finds_nine_in_ten(spark):
    for sf in ("sf0.01", "sf0.1"):
        assert QS.ivf_recall(spark, f"/root/testdata/{sf}").first().recall >= 0.9


def test_ivf_probing(spark, vectors):
    m, df = vectors
    q = queries_of(spark, m, range(0, 400, 40))
    cells, centres = SE.assign_cells(df, cells=10)
    exact = SE.dense_top_k(q, df, 10)
    assert sorted(map(tuple, SE.ivf_top_k(q, cells, centres, 10, nprobe=10).collect())) == sorted(map(tuple, exact.collect()))
    part = SE.ivf_top_k(q, cells, centres, 10, nprobe=4)
    assert .5 < SE.recall(part, exact).head()["recall"] <= 1


def test_rouge_literal(spark):
    df = spark.createDataFrame([(1, "the the the cat lay on a mat", "the cat sat on the mat"), (2, "same words here", "same words here"),
                                (3, "", "x"), (4, None, "x")], "id long, generated string, reference string")
    out = {r["id"]: r for r in R.rouge(df, "id", stem=False).collect()}
    assert [out[1][c] for c in ("rouge1", "rouge2", "rougeL")] == pytest.approx([.714286, .166667, .571429], abs=1e-6)
    assert [out[2][c] for c in ("rouge1", "rouge2", "rougeL")] == [1, 1, 1]
    assert [out[i][c] for i in (3, 4) for c in ("rouge1", "rouge2", "rougeL")] == [0] * 6


def test_subsequence_against_table_method():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = (list(rng.integers(0, 5, rng.integers(0, 90))) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert R.lcs_length(a, b) == table[-1, -1]


def test_extractive_rules(spark):
    short = "Only one sentence is in here. And a second one follows it."
    plain = "no marks at all " * 30
    four = ("Alpha beta gamma delta epsilon zeta. It is what it was then. Alpha beta gamma kappa lambda tau. "
            "Omega sigma rho phi chi psi.")
    df = spark.createDataFrame([(1, short), (2, plain), (3, four)], "id long, text string")
    out = {r["id"]: r["extractive_summary"] for r in SU.extractive(df, "id", "text").collect()}
    assert out[1] == short and out[2] == plain
    assert out[3] == four.replace("It is what it was then. ", "")


def test_second_summary_passes_short_text_through(spark):
    df = spark.createDataFrame([(1, "a few  words only"), (2, "One two three four five six. " * 400)], "id long, text string")
    out = {r["id"]: r["centroid_summary"] for r in SU.centroid(df, "id", "text").collect()}
    assert out[1] == "a few  words only" and len(out[2].split()) == 18
    cut = {r["id"]: r["centroid_summary"] for r in SU.centroid(df, "id", "text", max_words=3).collect()}
    assert cut == {1: "a few words", 2: "One two three"}


def test_hot_cluster_is_cut_before_the_exchange(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("c"), F.col("id").cast("string").alias("text"))
    docs = SU.cluster_documents(df, "c", "id", 3)
    out = {r["c"]: (r["n_posts"], r["document"]) for r in docs.collect()}
    assert out == {"hot": (4500, "0 1 2"), "cold": (500, "9 19 29")}
    assert "WindowGroupLimit" in docs._jdf.queryExecution().executedPlan().toString()


def test_topic_merge_is_transitive_and_keeps_outliers(spark):
    groups = spark.createDataFrame([(0,), (1,), (2,), (3,)], "g int")
    pairs = spark.createDataFrame([(1, 2, .9), (2, 3, .9)], "a int, b int, s double")
    posts = spark.createDataFrame([(10, 3), (11, 0), (12, -1)], "id long, topic int")
    out = T.merge_topics(posts, T.merge_map(groups, pairs))
    assert {r["id"]: r["topic"] for r in out.collect()} == {10: 1, 11: 0, 12: -1}


def test_code_search_is_exact_with_everything_read(spark, vectors):
    m, df = vectors
    index = CO.CodeIndex.build(df, groups=3)
    hits = index.search(queries_of(spark, m, [0, 50, 399]), 7, probes=10_000, short=400).collect()
    assert sorted((r.query_id, r["rank"], r.idx) for r in hits) == sorted((q, rank, i) for q in (0, 50, 399) for rank, (_, i) in enumerate(
        sorted((-round(float(np.float64(m[q]) @ m[i]), 9), i) for i in range(len(m)))[:7], 1))


def test_codes_come_close_and_cells_grow(spark):
    rng = np.random.default_rng(3)
    for n in (1, 40, 900):
        rows = rng.normal(size=(n, 8))
        coder = CO.Quantiser(rows, max(1, round(n ** .5)), 4)
        cell, codes = coder.encode(rows)
        assert codes.shape == (n, 4) and len(coder.centres) <= 2 * max(1, round(n ** .5)) + 1
        assert ((coder.decode(cell, codes) - rows) ** 2).sum() <= ((coder.centres[cell] - rows) ** 2).sum() + 1e-9
        assert (cell[:, None] == np.arange(len(coder.centres))).any(0).sum() >= min(n, 3)


def test_code_search_without_rows(spark, vectors):
    m, df = vectors
    none = df.filter("idx > 1000")
    assert CO.CodeIndex.build(none).search(queries_of(spark, m, [1])).count() == 0
    assert CO.CodeIndex.build(df).search(queries_of(spark, m, [1]).limit(0)).count() == 0


@pytest.mark.parametrize("at_least", [0.05, 0.3, 0.7, 0.95, 1.0])
def test_similar_groups_lose_no_pair(spark, at_least):
    """Against all cosines; equal groups, a group alone, one without weight."""
    rng = np.random.default_rng(8)
    table = rng.random((25, 60)) * (rng.random((25, 60)) < .25) * np.exp(rng.normal(size=60))
    table[4], table[9], table[11] = table[3], table[3] + .02, 0
    rows_ = [(int(g), f"w{t:02}", float(w)) for (g, t), w in np.ndenumerate(table) if w] + [(11, "w00", 0.0), (99, "own", 1.0), (None, "w01", 1.0)]
    got = {(r["a"], r["b"]): r["similarity"] for r in T.similar_groups(spark.createDataFrame(rows_, "g int, term string, weight double"), "g", at_least).collect()}
    unit = table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-300)
    cos = unit @ unit.T
    want = {(a, b): round(cos[a, b], 9) for a in range(25) for b in range(a + 1, 25) if round(cos[a, b], 9) >= at_least}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 2e-9 for p in want)
    assert (3, 4) in got


def test_similar_groups_of_nothing(spark):
    empty = spark.createDataFrame([], "g int, term string, weight double")
    assert T.similar_groups(empty, "g", .5).count() == 0
    with pytest.raises(ValueError):
        T.similar_groups(empty, "g", 0.0)
