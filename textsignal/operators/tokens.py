"""Token tables: explode, vocabulary joins, lemmas, parts of speech, stems."""
from pyspark.sql import Window as W, functions as F

from textsignal import vocab
from textsignal.functions import text as X
from textsignal.functions.stemming import stem
from textsignal.operators import dictionary
from textsignal.operators.bounds import unnest


def explode_tokens(df, id_col, tokens="tokens"):
    """One row per token: (id, pos, token)."""
    return unnest(df, [id_col], tokens, "token", "pos")


def adjacent_pairs(tokens_df, id_col):
    """Bigrams of an exploded token table."""
    nxt = F.lead("token").over(W.partitionBy(id_col).orderBy("pos"))
    return (tokens_df.withColumn("_next", nxt).filter(F.col("_next").isNotNull())
            .select(id_col, "pos", F.concat_ws(" ", "token", "_next").alias("gram")))


def drop_listed(tokens_df, words_df):
    """Tokens that are not in a word table of any size."""
    return dictionary.keep(tokens_df, "token", words_df, False)


def keep_listed(tokens_df, words_df):
    """Tokens that are in a word table of any size."""
    return dictionary.keep(tokens_df, "token", words_df, True)


def lemmas(df, lexicon, tokens="tokens", name="lemmas"):
    """Add the lemma of each token from a (token, lemma) table of any size; unknown tokens are their own lemma."""
    found = dictionary.add_values(df, tokens, lexicon, "lemma", "_lemma")
    return found.withColumn(name, F.zip_with("_lemma", tokens, lambda l, t: F.coalesce(l, t))).drop("_lemma")


def lemmatize(df, id_col, lexicon, tokens="tokens", stopwords=vocab.STOPWORDS):
    """(id, tokens): lemmas from a (token, lemma) table with one row per token, unknown tokens unchanged; lemmas on the second stop
    list are dropped. A row without tokens has an empty array."""
    found = lemmas(df.select(id_col, tokens), lexicon, tokens, "_lemmas")
    return found.select(id_col, F.filter("_lemmas", lambda t: t.isNotNull() & ~X.in_words(t, stopwords)).alias(tokens))


def adjectives_and_nouns(df, id_col, lexicon, tokens="tokens", function_words=vocab.STOPWORDS):
    """(id, tokens): those tagged JJ* or NN*, from a (token, pos) table with one row per token, and word-shape defaults."""
    found = dictionary.add_values(df.select(id_col, tokens), tokens, lexicon, "pos", "_tag")
    tagged = F.zip_with(tokens, "_tag", lambda t, p: F.when(X.is_adjective_or_noun(X.part_of_speech(t, p, function_words)), t))
    return found.select(id_col, F.array_compact(tagged).alias(tokens))


def stem_vocabulary(tokens_df):
    """(token, stem) for each distinct token, so that a word is stemmed once and not once per use."""
    return tokens_df.select("token").distinct().withColumn("stem", stem(F.col("token")))


def stem_counts(tokens_df):
    """Uses per stem. Tokens are counted first, so each word is stemmed once."""
    counts = tokens_df.groupBy("token").count()
    return (counts.withColumn("stem", stem(F.col("token")))
            .groupBy("stem").agg(F.sum("count").alias("n"), F.count("*").alias("n_forms")))
