"""Work that must not be repeated or grow faster than the input."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textsignal.functions import text as X
from textsignal.operators import classify as C, embeddings as EM, entities as EN, features as FE, keyword as K, lda as LDA, summarize as SU, topics as T
from textsignal.operators.packing import pack, unpack
from textsignal.sources import writers


def test_packed_pairs_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        keys = np.unique(rng.integers(0, 1 << 60, n))
        sums = rng.integers(1, 1 << 40, len(keys))
        packed = EM._pack(keys, sums)
        assert [c.tolist() for c in EM._unpack(packed)] == [keys.tolist(), sums.tolist()]
    assert len(EM._pack(np.arange(0, 40_000, 4), np.ones(10_000, "int64"))) < 10_000


def test_words_are_numbered_by_use_and_a_block_has_few_partners(spark):
    """A pair lies in the block of its rarer word, so that a word of few uses is asked for by few blocks."""
    words = spark.range(500).select(F.concat(F.lit("w"), "id").alias("word"), F.xxhash64("id").alias("code"), (F.lit(1000) - F.col("id")).alias("n"))
    rows = sorted(EM._numbered(words, 5, 50_000, 10_000).collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == list(range(500)) and [r.word for r in rows] == [f"w{i}" for i in range(500)]
    for c in ("unit", "block"):
        assert [r[c] for r in rows] == sorted(r[c] for r in rows) and len({r[c] for r in rows}) > 5
    left = pa.table([pa.array([[5, 7, 5]], pa.list_(pa.int64()))], names=["codes"])
    right = pa.table([pa.array(c) for c in ([7, 5], [0, 3], [0, 1], [0, 1])], names=["code", "id", "unit", "block"])
    out = EM._pairs(2)(left, right).to_pylist()
    found = {(r["block"], int(k) >> 32, int(k) & 0xFFFFFFFF): int(x) for r in out for k, x in zip(*EM._unpack(r["pairs"]))}
    assert found == {(1, 3, 0): 4, (1, 3, 3): 1}
    assert [[c.tolist() for c in EM._unpack(r["words"])] for r in out] == [[[0], [4]], [[3], [6]]]


def test_document_vectors_are_made_once_for_their_clusters(spark):
    made = spark.sparkContext.accumulator(0)

    def make(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame.assign(embedding=[[float(i % 7), float(i % 3), 1.0] for i in frame["id"]])
    vectors = spark.range(100).mapInPandas(make, "id long, embedding array<double>")
    assert T.cluster_documents(vectors, "id", k=3, dims=2).count() == 100
    assert made.value == 100


def test_topic_parts_are_fitted_in_stretches(spark, monkeypatch):
    """A large part gives the same sums whether its documents are fitted together or in stretches."""
    rng = np.random.default_rng(2)
    lists = [sorted(rng.choice(40, rng.integers(1, 9), replace=False).tolist()) for _ in range(30)]
    left = pa.table([pa.array([0] * 30), pa.array(lists, pa.list_(pa.int64())), pa.array([[1 + c % 3 for c in l] for l in lists], pa.list_(pa.int32()))], names=["_part", "codes", "n"])
    right = pa.table([pa.array(np.arange(40)), *[pa.array(rng.random(40) + 0.5) for _ in range(3)]], names=["code", "s0", "s1", "s2"])
    found = []
    for size in (512, 7):
        monkeypatch.setattr(LDA, "TOGETHER", size)
        rows = LDA._fit_part(["s0", "s1", "s2"], np.full(3, 1 / 3), np.zeros(3))(left, right).to_pylist()
        found.append({(r["code"], c): r[c] for r in rows for c in ("s0", "s1", "s2", "docs")})
    assert found[0] == pytest.approx(found[1]) and found[0][None, "docs"] == 30


def test_packed_documents_come_back_and_fit_as_lists_do():
    """Documents of a topic model travel as a byte or two for each term, not as twelve."""
    rng = np.random.default_rng(3)
    places = [np.sort(rng.choice(5_000, rng.integers(1, 300), replace=False)) for _ in range(200)]
    start, place = np.append(0, np.cumsum([len(x) for x in places])), np.concatenate(places)
    n = rng.integers(1, 4, len(place))
    bag = LDA._packed(start, place, n)
    assert [c.tolist() for c in LDA._unpacked(bag)] == [start.tolist(), place.tolist(), n.tolist()]
    assert len(bag) < 3 * len(place)
    right = pa.table([pa.array(np.arange(5_000) * 7), *[pa.array(rng.random(5_000) + 0.5) for _ in range(2)]], names=["code", "s0", "s1"])
    lists = pa.table([pa.array([4] * 200), pa.array([(x * 7).tolist() for x in places], pa.list_(pa.int64())), pa.array([n[a:b].tolist() for a, b in zip(start, start[1:])], pa.list_(pa.int32()))], names=["_part", "codes", "n"])
    packed = pa.table([pa.array([4]), pa.array([bag], pa.binary())], names=["_part", "bag"])
    fit = LDA._fit_part(["s0", "s1"], np.full(2, 0.5), np.zeros(2))
    one, other = fit(lists, right).to_pydict(), fit(packed, right).to_pydict()
    assert one["code"] == other["code"] and set(other["_part"]) == {4} and other["docs"][-1] == 200
    assert all(one[c] == pytest.approx(other[c]) for c in ("s0", "s1"))


def _made(spark, schema, make):
    """A frame that is made in Python, and a counter of the times it was."""
    made = spark.sparkContext.accumulator(0)

    def run(frames):
        for frame in frames:
            made.add(len(frame))
            yield make(frame)
    return spark.range(40).mapInPandas(run, schema), made


def test_class_weights_read_the_texts_once(spark):
    df, made = _made(spark, "g string, tokens array<string>", lambda f: f[[]].assign(g=[f"g{i % 4}" for i in f["id"]], tokens=[["same", f"w{i % 4}", f"x{i % 2}"] for i in f["id"]]))
    pairs = T.similar_groups(T.class_tfidf(df, "g"), "g", 0.1)
    assert {(r.a, r.b) for r in pairs.collect()} >= {("g0", "g2"), ("g1", "g3")}
    assert made.value == 40


def test_ngrams_are_made_after_texts_are_hashed(spark):
    rows = [(i, f"alpha beta word{i} " + "gamma " * (i % 5)) for i in range(200)] + [(7, "alpha beta"), (None, "beta beta"), (9, None)]
    df = spark.createDataFrame(rows, "id long, text string")
    hashed = FE.hashed_texts(df, "id", "text", chars=100)
    assert hashed.rdd.getNumPartitions() > 30
    weights = lambda d, **more: {(r.id, r.term): (r.tf, round(r.weight, 9)) for r in FE.tfidf(FE.with_terms(d, "text", 2).select("id", "terms"), "id", max_features=50, **more).collect()}
    assert weights(hashed, hashed=True) == weights(df) != {}


def test_first_terms_are_cut_in_the_tasks(spark):
    counts = spark.range(5_000).select(F.concat(F.lit("t"), "id").alias("term"), (F.col("id") % 100).alias("cf"))
    found = [r.term for r in FE.top_terms(counts, 60).collect()]
    assert found == sorted(f"t{i}" for i in range(99, 5_000, 100)) + sorted(f"t{i}" for i in range(98, 5_000, 100))[:10]
    cut = list(FE._first_of_task("cf", 3)([pa.RecordBatch.from_pydict({"term": list("abcdef"), "cf": [1, 5, 5, 5, 2, 9]})]))
    assert [r["term"] for b in cut for r in b.to_pylist()] == ["f", "b", "c"]


def test_summaries_move_texts_and_not_their_words(spark):
    one = "Red cats sleep long. Blue dogs run far away. Red cats like blue dogs. Nobody knows the green bird. Red cats sleep all day."
    other = "Small towns grow slowly here. Large towns grow quickly there. Towns need many good roads. Roads need many good bridges."
    docs = spark.createDataFrame([(1, one), (2, other), (2, other), (3, None), (4, ""), (None, one), (5, "Just one sentence stands here.")], "id long, text string")
    short = SU.extractive(docs, "id", "text", n=2)
    assert "Window" not in short._jdf.queryExecution().toString()
    near = SU.centroid(docs, "id", "text", n=2, min_words=1)
    for rows, name in ((short, "extractive_summary"), (near, "centroid_summary")):
        found = sorted(((r.id, r[name]) for r in rows.collect()), key=str)
        assert len(found) == 7
        by_id = dict(found)
        assert by_id[5] == "Just one sentence stands here." and found.count((2, by_id[2])) == 2
        assert by_id[None] == "Nobody knows the green bird. Red cats sleep all day."
        assert by_id[2].count(".") == 2 and by_id[1].count(".") == 2


def test_packed_numbers_come_back():
    columns = [np.arange(5), np.zeros(0, "int64"), np.array([-3, 2**31 - 1])]
    assert [c.tolist() for c in unpack(pack(*columns))] == [c.tolist() for c in columns]


def test_keyword_counts_of_a_batch_are_made_in_stretches(monkeypatch):
    """Lists stay as long as the batch, whatever the stretches; no stretch holds more tokens than asked for, or one document."""
    rng = np.random.default_rng(5)
    texts = [[f"w{x}" for x in rng.integers(0, 30, rng.integers(0, 60))] for _ in range(50)]
    batch = pa.RecordBatch.from_pydict({"idx": np.arange(50) * 3, "shard": np.repeat([4, 5], 25), "tokens": pa.array(texts, pa.list_(pa.string()))})
    monkeypatch.setattr(K, "TOKENS", 100)
    cuts = list(K._cuts(np.array([len(t) for t in texts])))
    assert len(cuts) > 5 and [i for i, _ in cuts[1:]] == [j for _, j in cuts[:-1]] and all(sum(map(len, texts[i:j - 1])) <= 100 for i, j in cuts)
    few = [r for b in K._count([batch]) for r in b.to_pylist()]
    monkeypatch.setattr(K, "TOKENS", 10**9)
    assert few == [r for b in K._count([batch]) for r in b.to_pylist()]
    assert sum(len(r["ids"]) for r in few if r["term"] == K.EVERY) == 50
    rows = pa.RecordBatch.from_pylist(few, pa.schema([("term", pa.string()), ("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int32())), ("lens", pa.list_(pa.int32()))]))
    whole = [r for b in K._post(1.5, 0.75, 30.0)([rows]) for r in b.to_pylist()]
    monkeypatch.setattr(K, "TOKENS", 100)
    parts = list(K._post(1.5, 0.75, 30.0)([rows.slice(0, 7), rows.slice(7)]))
    assert len(parts) > 2 and [r for b in parts for r in b.to_pylist()] == whole


def test_phrases_hold_the_words_of_few_texts(spark, monkeypatch):
    table = spark.createDataFrame([("new york", "LOC"), ("york", "PER")], "phrase string, label string")
    posts = spark.createDataFrame([(i, "in New York " * (i % 3) + "York") for i in range(20)], "id long, text string")
    found = []
    for size in (3, 1_000):
        monkeypatch.setattr(EN, "TOGETHER", size)
        found.append(sorted(map(tuple, EN.phrases_by_join(posts, "id", table, text="text").collect())))
    assert found[0] == found[1] and len(found[0]) == sum(i % 3 + 1 for i in range(20))


def test_texts_of_a_validated_fit_are_made_once(spark):
    docs, made = _made(spark, "id long, text string, label string",
                       lambda f: f[["id"]].assign(text=["good happy day" if i % 2 else "bad sad night" for i in f["id"]], label=["a" if i % 2 else "b" for i in f["id"]]))
    _, report, label_map, _ = C.fit_with_validation(docs, "text", "label", "id", strengths=(1.0,))
    assert report.count() > 2 and label_map.count() == 2
    assert made.value == 40


def test_contractions_are_split_as_whole_words(spark):
    """The faster pattern finds what the plain one does."""
    ends = ["", "x", " ", "-", "é", "_", "1", "\U0001D4B3", "\U0001F600", "\n", "cannot"]
    rows = spark.createDataFrame([(a + w + b,) for w in ("cannot", "wanna") for a in ends for b in ends], "t string")
    plain = F.col("t")
    for w, l, r in (("cannot", "can", "not"), ("wanna", "wan", "na")):
        plain = F.regexp_replace(plain, rf"(?<!{X.WORD}){w}(?!{X.WORD})", f"{l} {r}")
    pairs = rows.select(X.split_contractions(F.col("t")), plain).collect()
    assert all(a == b for a, b in pairs) and any(a == "can not" for a, _ in pairs)


def test_clusters_are_summarised_from_packed_parts(spark, monkeypatch):
    """Sums over small parts and ranges give what one part gives; posts are made for their sentences and for their number, words move once for a part."""
    made, kept = spark.sparkContext.accumulator(0), {}
    subjects, verbs = ["Red cats", "Blue dogs", "Small towns", "Green birds", "Good roads"], ["sleep very long", "run far away", "grow slowly here", "never come back"]
    texts = [" ".join(f"{subjects[(i * 3 + j * j) % 5]} {verbs[(i + j) % 4]} with word{i % 4}." for j in range(1 + i % 6)) for i in range(40)]

    def make(frames):
        for frame in frames:
            made.add(len(frame))
            i = frame["id"]
            yield frame.assign(post=[None if x % 13 == 5 else x // 2 for x in i], text=["Too short." if x % 5 == 4 else None if x == 7 else texts[x // 2] for x in i], label=["abcde"[x % 5] if x % 11 else None for x in i])[["post", "text", "label"]]
    df = spark.range(80).mapInPandas(make, "post long, text string, label string")
    monkeypatch.setattr(SU, "stored", lambda df, name: kept.setdefault(name, []).append(out := writers.stored(df, name)) or out)
    found = []
    for tokens, pairs in ((10**9, 10**9), (60, 25)):
        monkeypatch.setattr(SU, "TOKENS", tokens)
        monkeypatch.setattr(SU, "PAIRS", pairs)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(tokens, 10_000) // 10)
        found.append([tuple(r) for r in SU.summarize_clusters(df.coalesce(1), "label", "post", n=2).collect()])
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert kept["sums"][-1].filter("part < 0").count() == 1 if tokens > 60 else kept["sums"][-1].filter("part < 0").count() > 10
    assert found[0] == found[1] and [r[0] for r in found[0]] == list("abcde") and kept["parts"][1].count() > 5
    assert found[0][4][2:] == ("Too short. Too short.",) * 2
    assert "terms" not in kept and all(r[2].count(".") >= 2 for r in found[0])


def test_clusters_without_usable_sentence_are_rare_and_their_texts_only_move_then(spark):
    df, made = _made(spark, "post long, text string, label string", lambda f: f[[]].assign(post=f["id"], text=["One two three four five. Six seven eight nine ten."] * len(f), label=["a" if i % 2 else "b" for i in f["id"]]))
    assert [(r.cluster_id, r.n_posts) for r in SU.summarize_clusters(df, "label", "post").collect()] == [("a", 20), ("b", 20)]
    assert made.value == 80


def test_clusters_of_no_posts_and_of_unusual_keys(spark):
    empty = spark.createDataFrame([], "post string, text string, label int")
    assert SU.summarize_clusters(empty, "label", "post").collect() == []
    df = spark.createDataFrame([("x", "no", 3), (None, "All of these words stand here. The of and to a is in it.", 4), ("y", "The of and to a is in it.", 5)], "post string, text string, label int")
    assert [tuple(r) for r in SU.summarize_clusters(df, "label", "post").collect()] == [
        (3, 1, "no", "no"), (4, 1, "All of these words stand here. The of and to a is in it.", "All of these words stand here. The of and to a is in it."), (5, 1, "The of and to a is in it.", "The of and to a is in it.")]


def test_signs_meet_pairs_in_the_blocks_of_both_words(spark, monkeypatch):
    """The first product is made of whole rows: a pair reaches the block of either word once, and only top words have rows in several blocks."""
    starts, blocks = np.array([0, 3, 7]), np.array([0, 2, 5])
    keys, x = np.array([(8 << 32) + 1, (8 << 32) + 3, (8 << 32) + 5, (9 << 32) + 3, (9 << 32) + 8]), np.arange(1, 6)
    turned = [r for b in EM._turned_over(starts, blocks, 2)([pa.RecordBatch.from_pydict({"block": [5], "pairs": [EM._pack(keys, x)]})]) for r in b.to_pylist()]
    assert [(r["block"], [c.tolist() for c in EM._unpack(r["pairs"])]) for r in turned] == [(2, [keys[1:4].tolist(), [2, 3, 4]])]
    rng, seen = np.random.default_rng(3), []
    texts = [(i, [f"w{int(w)}" for w in 600 * rng.random(40) ** 2]) for i in range(400)]
    project = EM._project
    monkeypatch.setattr(EM, "_project", lambda *given: seen.append(given) or project(*given))
    monkeypatch.setattr(EM, "stored", lambda df, name: seen.append(made := writers.stored(df, name)) or made)
    vectors = EM.train_word_vectors(spark.createDataFrame(texts, "id long, tokens array<string>"), size=20, block_pairs=1_000)
    *_, blocked, top = next(x for x in seen if isinstance(x, tuple))
    assert vectors.count() > 500 and len(blocked) > 3 and 0 < top < 500
