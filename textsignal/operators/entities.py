"""Phrase and time entities of a post.

`with_phrases` works inside the row: no shuffle, works on streams, takes the gazetteer as a dictionary.
`phrases_by_join` takes a gazetteer table of any size.
"""
import pyarrow as pa
from pyspark.sql import functions as F

from textsignal import vocab
from textsignal.functions import text as X
from textsignal.operators import dictionary
from textsignal.operators.bounds import bind

# Texts whose words a task holds as Python strings at once.
TOGETHER = 128
ENTITY = "array<struct<start:int,n_words:int,phrase:string,label:string>>"
FOUND = pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("phrase", pa.string()), ("label", pa.string())]))


def gazetteer_rows(phrases):
    """(phrase, label, n_words) columns of a phrase → label dictionary."""
    keys = list(phrases)
    return {"phrase": keys, "label": [phrases[k] for k in keys], "n_words": [len(k.split()) for k in keys]}


def _longest_first(candidates):
    """Greedy choice inside a row: longest phrase first, then the earlier one; no overlaps."""
    key = lambda e: F.struct((-e["n_words"]).alias("rank"), e["start"].alias("start"),
                             e["n_words"].alias("n_words"), e["phrase"].alias("phrase"), e["label"].alias("label"))
    ordered = F.array_sort(F.transform(candidates, key))
    plain = lambda e: F.struct(e["start"].alias("start"), e["n_words"].alias("n_words"),
                               e["phrase"].alias("phrase"), e["label"].alias("label"))
    overlaps = lambda a, b: (a["start"] < b["start"] + b["n_words"]) & (b["start"] < a["start"] + a["n_words"])
    chosen = F.aggregate(
        F.transform(ordered, plain), F.array().cast(ENTITY),
        lambda acc, e: F.when(F.exists(acc, lambda a: overlaps(a, e)), acc)
        .otherwise(F.concat(acc, F.array(e))).cast(ENTITY))
    return F.array_sort(chosen)


def with_phrases(df, phrases=None, text="text_clean_deep", max_chars=None, name="entities"):
    """Add the phrases found in a text, as whole tokens in any case, in text order and as they are written there.

    Only positions whose first word opens some phrase are looked at further.
    """
    phrases = vocab.gazetteer() if phrases is None else phrases
    phrases = {p.lower(): label for p, label in phrases.items()}
    if not phrases:
        return df.withColumn(name, F.array().cast(ENTITY))
    by_length = {}
    for p in phrases:
        by_length.setdefault(len(p.split()), []).append(p)
    openers = {p.split()[0] for p in phrases}
    body = F.col(text) if max_chars is None else X.head_chars(F.col(text), max_chars)
    tokens = F.col("_tokens")

    def at(i):
        found = []
        for n, listed in sorted(by_length.items()):
            phrase = F.array_join(F.slice(tokens, i + 1, n), " ")
            folded = F.lower(phrase)
            hit = (i + n <= F.size(tokens)) & X.in_words(folded, listed)
            found.append(F.when(hit, F.struct(i.alias("start"), F.lit(n).alias("n_words"), phrase.alias("phrase"),
                                              X.lookup(folded, phrases).alias("label"))))
        return F.array_compact(F.array(*found))

    starts = F.filter(F.transform("_tokens", lambda t, i: F.when(X.in_words(F.lower(t), openers), i)), lambda i: i.isNotNull())
    df = bind(bind(df, _tokens=X.tokenize(body, "whitespace")), _found=F.flatten(F.transform(starts, at)))
    chosen = F.when(F.size("_found") == 0, F.array().cast(ENTITY)).otherwise(_longest_first(F.col("_found")))
    return bind(df, **{name: chosen}).drop("_tokens", "_found")


def phrases_by_join(df, id_col, gazetteer, max_words=None, text="text_clean_deep", max_chars=None):
    """(id, start, n_words, phrase, label) rows from a (phrase, label) table of any size, in any case, phrases as written.

    Posts meet the phrases by their first words only, and each part of the posts looks along a prefix tree of those that
    its words can open. Phrases of more than `max_words` words are left out, if it is given. A phrase listed twice has the lesser label.
    """
    body = F.col(text) if max_chars is None else X.head_chars(F.col(text), max_chars)
    rows = df.select(id_col, X.tokenize(body, "whitespace").alias("_words")).filter(F.size("_words") > 0)
    rows = rows.select(id_col, "_words", F.transform("_words", lambda t: F.lower(t)).alias("_folded"))
    folded = X.tokenize(F.lower("phrase"), "whitespace")
    listed = gazetteer.select(F.get(folded, F.lit(0)).alias("token"), F.array_join(folded, " ").alias("phrase"), "label").filter(F.col("token").isNotNull())
    if max_words is not None:
        listed = listed.filter(F.size(F.split("phrase", " ")) <= max_words)
    kind = df.schema[id_col].dataType.simpleString()

    def apply(batch, entries):
        pairs = sorted(zip(entries.column("phrase").to_pylist(), entries.column("label").to_pylist()), reverse=True)
        number, root = dictionary.phrase_trie(pairs)
        found = [pa.array([], FOUND)]
        for begin in range(0, batch.num_rows, TOGETHER):
            some = batch.slice(begin, TOGETHER)
            found.append(pa.array([[{"start": i, "n_words": n, "phrase": " ".join(words[i:i + n]), "label": label} for i, n, label in dictionary.find_phrases(low, number, root)]
                                   for words, low in zip(some.column("_words").to_pylist(), some.column("_folded").to_pylist())], FOUND))
        return pa.RecordBatch.from_arrays([batch.column(id_col), pa.concat_arrays(found)], names=[id_col, "found"])

    per_post = dictionary.look_up(rows, "_folded", listed, apply, f"`{id_col}` {kind}, found {ENTITY}")
    return (per_post.filter(F.size("found") > 0).select(id_col, F.explode(_longest_first(F.col("found"))).alias("e"))
            .select(id_col, "e.*"))


def entity_map(entities):
    """Found phrases as label → list, labels in order of first mention."""
    labels = F.array_distinct(F.transform(entities, lambda e: e["label"]))
    return F.map_from_entries(F.transform(labels, lambda l: F.struct(
        l.alias("key"),
        F.transform(F.filter(entities, lambda e: e["label"] == l), lambda e: e["phrase"]).alias("value"))))


def extract(df, phrases=None, text="text_clean_deep", max_chars=None, name="entities"):
    """Add the entity map of a post: phrases of the whole text (or of its first `max_chars` characters, if asked),
    and TEMPORAL, only if there is any, from the whole text."""
    times = X.temporal_expressions(F.col(text))
    found = bind(with_phrases(df, phrases, text, max_chars, "_phrases"), _times=times)
    both = F.when(F.size("_times") > 0,
                  F.map_concat(entity_map(F.col("_phrases")), F.create_map(F.lit("TEMPORAL"), F.col("_times")))
                  ).otherwise(entity_map(F.col("_phrases")))
    return found.withColumn(name, both).drop("_phrases", "_times")


def extract_second(df, phrases, text="text_clean_deep", max_chars=None,
                   name="second_entities"):
    """A second, independent tagger from another gazetteer; an empty map where nothing is found."""
    return (with_phrases(df, phrases, text, max_chars, "_phrases")
            .withColumn(name, F.coalesce(entity_map(F.col("_phrases")), F.map_from_arrays(
                F.array().cast("array<string>"), F.array().cast("array<array<string>>"))))
            .drop("_phrases"))


def entity_json(c):
    return F.to_json(c)


def parse_entity_json(c):
    return F.from_json(c, "map<string,array<string>>")


def mention_counts(df, label, entities="entities", name="entity"):
    """Mentions per phrase of one type, case-folded, all mentions counted; most frequent first."""
    return (df.select(F.explode(F.col(entities)[label]).alias("_e"))
            .groupBy(F.lower("_e").alias(name)).agg(F.count("*").alias("count"))
            .orderBy(F.desc("count"), name))
