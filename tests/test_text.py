import random

import porter
import pytest
from pyspark.sql import functions as F

from textsignal import vocab
from textsignal.functions import stemming, text as X, vectors as V
from textsignal.functions.stemming import stem
from textsignal.operators import ingest, rows, tokens as TK
from textsignal.operators.bounds import local_table

DEMO = ("We're *still* waiting for **answers** today. u/quiet_reader linked r/gardening but nobody's been back since noon "
        "https://t.co/abc. Nights stay long &amp; cold.")


def value(spark, fn, *inputs):
    df = spark.createDataFrame([inputs], ", ".join(f"c{i} string" for i in range(len(inputs))))
    return df.select(fn(*[F.col(c) for c in df.columns]).alias("v")).head()["v"]


def test_noise_removal(spark):
    assert value(spark, X.remove_noise, DEMO) == (
        "We're still waiting for answers today. linked but nobody's been back since noon Nights stay long cold.")


@pytest.mark.parametrize("text, expected", [
    (DEMO, "were still waiting for answers today linked but nobodys been back since noon nights stay long cold"),
    ("See [my post](https://x.co/a) and (more) here. and/or her/him &amp; &#39;x y’s", "see here andor he 39x y’s"),
    ("[ok](http://a.b) end", "ok end"),
    ("see [a] (b) [c](d)", "see"),
    ("you/me and her/him", "yo and he"),
    ("a - b", "a  b"), ("- hi", " hi"), ("AT&T;x www.foo.com) z", "atx z"),
    ("r/cafés x", "x"), ("a  b", "a b"), (None, None),
])
def test_clean_deep(spark, text, expected):
    assert value(spark, X.clean_deep, text) == expected


def test_link_text_can_be_kept(spark):
    assert value(spark, lambda c: X.clean_deep(c, links="keep_text"), "see [my post](https://x.co/a) now") == "see my post now"


def test_blank_posts_are_dropped(spark):
    df = spark.createDataFrame([(1, "> * _ ~ `"), (2, "ok"), (3, None), (4, "https://x.y")], "post_id long, text string")
    assert [r["post_id"] for r in ingest.clean_posts(df).collect()] == [2]


def test_cleaning_runs_once_per_row(spark):
    df = spark.createDataFrame([(1, "a")], "post_id long, text string")
    plan = ingest.clean_posts(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("http[") == 1


def test_tokenizers(spark):
    text = "i cannot say “gonna” wanna  go"
    assert value(spark, lambda c: X.tokenize(c, "whitespace"), text) == ["i", "cannot", "say", "“gonna”", "wanna", "go"]
    assert value(spark, X.tokenize, text) == ["i", "can", "not", "say", "“", "gon", "na", "”", "wan", "na", "go"]
    with pytest.raises(ValueError):
        X.tokenize(F.lit("a"), "other")


def test_stopwords_and_short_tokens(spark):
    assert value(spark, lambda c: X.remove_stopwords(X.tokenize(c)), "i dont like the x of it very much") == ["dont", "like", "much"]


def test_sentences(spark):
    text = " One two three four five.  Six seven!  a b c d e f? tail of it is here "
    assert value(spark, X.sentences, text) == ["One two three four five.", "a b c d e f?", "tail of it is here"]


def test_temporal_order(spark):
    text = ("for the past 3 years i felt it 3 years ago and since may 2020 for 2 months of this since 20201 before 10 days")
    assert value(spark, X.temporal_expressions, text) == [
        "3 years ago", "2 months of this", "since may 2020", "since 2020", "for the past 3 years", "for 2 months"]


@pytest.mark.parametrize("score, name", [(0.05, "positive"), (0.0499, "neutral"), (0.0, "neutral"), (-0.05, "negative")])
def test_sentiment_class(spark, score, name):
    assert spark.range(1).select(X.sentiment_class(F.lit(score)).alias("v")).head()["v"] == name


def test_na_spellings(spark):
    assert [value(spark, X.null_if_na, s) for s in ("", "nan", "NA", "ok", None)] == [None, None, None, "ok", None]


STEMS = [
    ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"),
    ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"),
    ("happy", "happi"), ("relational", "relat"), ("rational", "ration"), ("digitizer", "digit"), ("hopefulness", "hope"),
    ("triplicate", "triplic"), ("electrical", "electr"), ("adjustable", "adjust"), ("adoption", "adopt"), ("effective", "effect"),
    ("probate", "probat"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("is", "is"),
]


def test_stems(spark):
    """A literal table; then words of all endings against the plain form of the algorithm."""
    words = spark.createDataFrame(STEMS, "word string, stem string")
    assert words.filter(stem(F.col("word")) != F.col("stem")).collect() == []
    ends = [s for s, _ in stemming.STEP_2 + stemming.STEP_3] + stemming.STEP_4 + ["s", "sses", "ies", "ed", "eed", "ing", "y", "yy", "e", "ll", ""]
    rng = random.Random(3)
    made = ["".join(rng.choice("aeiouybclstwxz") for _ in range(rng.randrange(0, 7))) + rng.choice(ends) + rng.choice(["", "", rng.choice(ends)]) for _ in range(20_000)]
    made += ["", "Y", "yyyy", "sky's", "ÉTÉS", "naïvely", "a\nb\ning", "\n", "İing", "漢字ing"]
    got = spark.createDataFrame([(made,)], "words array<string>").select(stemming.stems(F.col("words")).alias("s")).head()["s"]
    assert [(w, g) for w, g in zip(made, got) if g != porter.stem(w)] == []
    odd = spark.createDataFrame([(["hopes", None],), ([],), (None,)], "words array<string>").select(stemming.stems(F.col("words")).alias("s"))
    assert [r["s"] for r in odd.collect()] == [["hope", None], [], None]


def test_stem_counts(spark):
    df = spark.createDataFrame([("hopes",), ("hope",), ("hoping",), ("sad",), ("hope",)], "token string")
    assert {(r["stem"], r["n"], r["n_forms"]) for r in TK.stem_counts(df).collect()} == {("hope", 4, 3), ("sad", 1, 1)}


def test_adjectives_and_nouns(spark):
    tags = local_table(spark, {"token": ["we", "find", "quiet", "green", "each", "garden"],
                               "pos": ["PRP", "VBP", "JJ", "JJ", "DT", "NN"]}, "token string, pos string")
    df = spark.createDataFrame([(1, "We find quiet and green each garden"), (2, "")], "id long, text string")
    df = df.select("id", X.tokenize(X.clean_deep(F.col("text"))).alias("tokens"))
    out = {r["id"]: r["tokens"] for r in TK.adjectives_and_nouns(df, "id", tags).collect()}
    assert out == {1: ["quiet", "green", "garden"], 2: []}


def test_lemmas_keep_order_and_empty_rows(spark):
    lemmas = local_table(spark, {"token": ["feeling", "was"], "lemma": ["feel", "be"]}, "token string, lemma string")
    df = spark.createDataFrame([(1, ["feeling", "sad", "was", "feeling"]), (2, [])], "id long, tokens array<string>")
    out = {r["id"]: r["tokens"] for r in TK.lemmatize(df, "id", lemmas).collect()}
    assert out == {1: ["feel", "sad", "feel"], 2: []}


def test_dense_index_has_no_gaps(spark):
    df = spark.range(0, 5000, 7).union(spark.range(10**12, 10**12 + 300)).withColumnRenamed("id", "key")
    out = rows.dense_index(df, "key", ranges=16).orderBy("key").collect()
    assert [r["idx"] for r in out] == list(range(len(out))) and len(out) == 715 + 300


def test_vector_functions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0], [1.0, 3.0, 2.0])], "a array<double>, z array<double>, s array<double>")
    r = df.select(V.l2_normalize(F.col("a")).alias("a"), V.l2_normalize(F.col("z")).alias("z"), V.softmax(F.col("s")).alias("s"),
                  V.argmax(F.col("s")).alias("m"), V.dot(F.col("a"), F.col("a")).alias("d")).head()
    assert r["a"] == pytest.approx([0.6, 0.8]) and r["z"] == [0.0, 0.0] and sum(r["s"]) == pytest.approx(1) and r["m"] == 1 and r["d"] == 25


def test_vocabulary_sizes():
    assert len(vocab.MEDICATIONS) == 35 and len(vocab.DIAGNOSES) == 26 and len(vocab.PUNCTUATION) == 32
