import math

import pytest
from pyspark.sql import functions as F

from textsignal import vocab
from textsignal.functions import text as X
from textsignal.operators import entities as E, ingest, sentiment
from textsignal.operators.bounds import local_table

LEXICON = {"good": 1.9, "bad": -2.5, "kind": 2.4, "no": -1.2, "happy": 2.7, "great": 3.1}


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


CASES = [
    ("good", 1.9), ("very good", 1.9 + 0.293), ("very bad", -2.5 - 0.293), ("hardly good", 1.9 - 0.293),
    ("not good", 1.9 * -0.74), ("not very good", (1.9 + 0.293) * -0.74), ("very much x good", 1.9 + 0.293 * 0.9),
    ("so x good", 1.9 + 0.293 * 0.95), ("not x y good", 1.9 * -0.74), ("not x y z good", 1.9),
    ("never so good", (1.9 + 0.293) * 1.25), ("without doubt good", 1.9), ("good but bad", 1.9 * 0.5 - 2.5 * 1.5),
    ("bad bad but good", -2.5 * 0.5 * 2 + 1.9 * 1.5), ("no good", 1.9 * -0.74), ("no", -1.2), ("kind of bad", -2.5),
    ("he was kind of bad", -2.5 - 0.293), ("he was kind of good", 1.9 - 0.293), ("it just enough good", 1.9 - 0.293), ("x y the bomb good", 3.0),
    ("the bomb good", 1.9), ("a b c bad ass", 1.5), ("x yeah right good", -2.0), ("good yeah right good", 3.8),
    ("the least good", 1.9 * -0.74), ("at least good", 1.9), ("nothing here", 0.0), ("", 0.0), ("bad good", -2.5 + 1.9),
]


def test_sentiment_rules_in_both_forms(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "id long, text_clean_deep string")
    inside = {r["id"]: r for r in sentiment.score(df, LEXICON).collect()}
    table = local_table(spark, {"token": list(LEXICON), "valence": list(LEXICON.values())}, "token string, valence double")
    joined = {r["id"]: r for r in sentiment.score_by_join(df, "id", table).collect()}
    for i, (text, total) in enumerate(CASES):
        assert inside[i]["vader_compound"] == pytest.approx(compound(total), abs=1e-4), text
        shares = [inside[i]["vader_" + c] for c in ("pos", "neg", "neu")]
        assert sum(shares) == pytest.approx(1.0 if text else 0.0, abs=0.002)
        for c in ("vader_compound", "vader_pos", "vader_neg", "vader_neu", "vader_sentiment"):
            assert inside[i][c] == joined[i][c], (text, c)


def test_filtering_scores_does_not_repeat_the_rules(spark):
    df = spark.createDataFrame([(1, "very good")], "id long, text_clean_deep string")
    scored = sentiment.score(df, LEXICON)
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert size(scored.filter("vader_sentiment = 'positive'")) < 1.5 * size(scored)


def found(spark, text, **kw):
    df = spark.createDataFrame([(1, text)], "id long, text_clean_deep string")
    return [(e["phrase"], e["label"]) for e in E.with_phrases(df, **kw).head()["entities"]]


def test_longest_phrase_wins(spark):
    assert found(spark, "i had social anxiety and anxiety") == [("social anxiety", "DIAGNOSIS"), ("anxiety", "DIAGNOSIS")]
    names = {"new york": "LOC", "york times square": "LOC", "times": "ORG"}
    assert found(spark, "the new york times square", phrases=names) == [("york times square", "LOC")]
    assert found(spark, "new york times", phrases=names) == [("new york", "LOC"), ("times", "ORG")]
    assert found(spark, "nothing", phrases=names) == [] and found(spark, "x", phrases={}) == []


def test_join_form_gives_the_same(spark):
    rows = [(i, f"took {m} for generalized anxiety disorder and {d} attack panic disorder") for i, (m, d) in
            enumerate(zip(vocab.MEDICATIONS, vocab.DIAGNOSES * 2))]
    df = spark.createDataFrame(rows, "id long, text_clean_deep string")
    inside = E.with_phrases(df).select("id", F.inline("entities")).collect()
    g = local_table(spark, E.gazetteer_rows(vocab.gazetteer()), "phrase string, label string, n_words int")
    joined = E.phrases_by_join(df, "id", g, 3).collect()
    assert sorted(map(tuple, inside)) == sorted(map(tuple, joined)) and len(inside) >= 70


def test_entity_map_and_json(spark):
    df = spark.createDataFrame([(1, "took zoloft for anxiety 3 years ago then prozac"), (2, "fine")], "id long, text_clean_deep string")
    out = {r["id"]: r["j"] for r in E.extract(df).select("id", E.entity_json(F.col("entities")).alias("j")).collect()}
    assert out == {1: '{"MEDICATION":["zoloft","prozac"],"DIAGNOSIS":["anxiety"],"TEMPORAL":["3 years ago"]}', 2: "{}"}


def test_phrases_are_found_in_the_whole_text_unless_it_is_cut(spark):
    df = spark.createDataFrame([(1, "x " * 600 + "zoloft since 2020")], "id long, text_clean_deep string")
    assert E.extract(df).head()["entities"] == {"MEDICATION": ["zoloft"], "TEMPORAL": ["since 2020"]}
    assert E.extract(df, max_chars=1000).head()["entities"] == {"TEMPORAL": ["since 2020"]}
    assert E.extract(df, max_chars=None).head()["entities"]["MEDICATION"] == ["zoloft"]


def test_mention_counts(spark):
    df = spark.createDataFrame([(1, "zoloft zoloft prozac"), (2, "prozac"), (3, "zoloft")], "id long, text_clean_deep string")
    assert [tuple(r) for r in E.mention_counts(E.extract(df), "MEDICATION", name="m").collect()] == [("zoloft", 3), ("prozac", 2)]


def test_merge_keeps_the_first_source_and_hides_behind_null_labels(spark):
    forum = spark.createDataFrame([(1, "a", "anxiety"), (2, "b", None), (3, None, "x")], "id long, post string, label string")
    stress = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 0), (4, "d", 2), (5, "e", None), (6, "c", 1)],
                                   "id long, text string, label int")
    merged = ingest.merge_sources([ingest.from_forum(forum, "forum", "id"), ingest.from_coded(stress, "stress", id_col="id")])
    assert sorted((r["text"], r["label"], r["source"]) for r in merged.collect()) == [
        ("a", "anxiety", "forum"), ("c", "not_stressed", "stress")]


def test_duplicates_are_reduced_before_the_exchange(spark):
    df = spark.range(20_000).select(F.col("id").alias("post_id"), F.lit(0).alias("source_rank"),
                                    F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    out = ingest.keep_first_copy(df)
    assert out.count() == 20_000 - 20_000 // 3 and out.filter("text = 'same'").head()["post_id"] == 0
    assert "partial_min" in out._jdf.queryExecution().executedPlan().toString()


def test_positional_columns(spark):
    df = spark.createDataFrame([("t", "l")], "body string, kind string")
    assert tuple(ingest.from_forum(df, "s").select("text", "label", "source").head()) == ("t", "l", "s")
