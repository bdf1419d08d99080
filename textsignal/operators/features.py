"""Counting terms and weighting them."""
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window as W, functions as F

from textsignal import config
from textsignal.functions import text as X
from textsignal.operators.bounds import unnest


def row_counts(df):
    """Rows and columns of a table."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def distinct_values(df, col):
    """Sorted distinct non-null values."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def hashed_texts(df, id_col, text, chars=config.HASHED_CHARS):
    """(id, text) hashed by id into parts of about `chars` characters, so that a task holds the terms of no more than these."""
    total = df.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).head()[0]
    parts = max(df.sparkSession.sparkContext.defaultParallelism, total // chars + 1)
    return df.select(id_col, text).repartition(parts, F.col(id_col))


def term_counts(df, id_col, terms="terms", hashed=False):
    """(id, term, tf). Rows are hashed by id first, unless they are already (`hashed`), as texts that are cut into terms
    only then: counting here, and every later sum or window per id, then shares this one exchange."""
    rows = df.select(id_col, F.col(terms).alias("_terms"))
    return (unnest(rows if hashed else rows.repartition(F.col(id_col)), [id_col], "_terms", "term")
            .groupBy(id_col, "term").agg(F.count("*").alias("tf")))


def corpus_counts(df, terms="terms"):
    """(term, df, cf): documents with the term and uses of it.

    The distinct terms of a row are found inside the row, so no (document, term) pairs are
    shuffled, only one partial count per task and term.
    """
    uses = F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(0).alias("d"), F.lit(1).alias("c")))
    first = F.transform(F.array_distinct(terms),
                        lambda t: F.struct(t.alias("term"), F.lit(1).alias("d"), F.lit(0).alias("c")))
    return (df.select(F.inline(F.concat(uses, first)))
            .groupBy("term").agg(F.sum("d").alias("df"), F.sum("c").alias("cf")))


def collection_counts(df, terms="terms"):
    """(term, cf) only."""
    return unnest(df, [], terms, "term").groupBy("term").agg(F.count("*").alias("cf"))


def top_terms(counts, n=config.MAX_FEATURES):
    """The n most used terms; ties alphabetically. The limit also proves the size of the result."""
    return _first_terms(counts, "cf", n)


def _first_of_task(by, n):
    """Task function: the first n terms by count, then name, among the rows of a task, cut again whenever they have piled up."""
    def cut(rows):
        return rows.take(pc.sort_indices(rows, [(by, "descending"), ("term", "ascending")])[:n]).combine_chunks()

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows > 4 * n + 10_000:
                held = cut(held)
        if held is not None:
            yield from cut(held).to_batches()
    return run


def _first_terms(counts, by, n, parts=64):
    """First n terms by count, then name. Tasks, then hash parts, are cut to n each before the final sort, so the whole
    vocabulary is not moved and the task that orders the result sees a fixed number of rows."""
    if n is None:
        return counts
    counts = counts.mapInArrow(_first_of_task(by, n), counts.schema)
    part = F.pmod(F.xxhash64("term"), F.lit(parts))
    rank = F.row_number().over(W.partitionBy("_part").orderBy(F.desc(by), "term"))
    cut = counts.withColumn("_part", part).withColumn("_r", rank).filter(F.col("_r") <= n).drop("_part", "_r")
    return cut.orderBy(F.desc(by), "term").limit(n)


def prune_terms(counts, n_docs, min_df=config.LDA_MIN_DF, max_df=config.LDA_MAX_DF, keep=None):
    """Terms in at least `min_df` documents and in at most a `max_df` share: all of them, or the most frequent `keep`.

    `n_docs` is a Column, normally a scalar subquery.
    """
    return _first_terms(counts.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs)), "df", keep)


def document_count(df):
    """Number of rows as a scalar subquery."""
    return df.agg(F.count("*").alias("n")).scalar()


def smooth_idf(n, df):
    return F.log((F.lit(1.0) + n) / (F.lit(1.0) + df)) + 1.0


def bag_of_words(df, id_col, vocabulary, terms="terms"):
    """In-vocabulary (id, term, tf). The vocabulary may be of any size: Spark broadcasts it only if it turns out small."""
    return term_counts(df, id_col, terms).join(vocabulary.select("term"), "term", "left_semi")


def tfidf(df, id_col, terms="terms", max_features=config.MAX_FEATURES, hashed=False):
    """(id, term, tf, weight): smooth idf, rows of unit length, vocabulary cut to the most used terms, or whole with None.

    The vocabulary is counted from the same per-document counts, so both branches start from one
    exchange and the text is tokenised once. With `hashed` the rows are hashed by id already.
    """
    tf = term_counts(df, id_col, terms, hashed)
    stats = tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    vocabulary = (top_terms(stats, max_features)
                  .withColumn("idf", smooth_idf(document_count(df), F.col("df"))).select("term", "idf"))
    bounded = max_features is not None and max_features <= config.BROADCAST_ROWS
    raw = tf.join(F.broadcast(vocabulary) if bounded else vocabulary, "term").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy(id_col)))
    return raw.select(id_col, "term", "tf", (F.col("raw") / norm).alias("weight"))


def with_terms(df, text, n=1, name="terms"):
    """Vectoriser terms of a text column: word tokens and their n-grams up to n. Plain columns, so that a
    plan that does not use them (a row count) drops them."""
    return (df.withColumn("_words", X.features_tokens(F.col(text)))
            .withColumn(name, X.grams_up_to(F.col("_words"), n)).drop("_words"))


def histogram(df, col, bins=50):
    """Equal-width histogram; the maximum belongs to the last bin."""
    lo_hi = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).alias("r"))
    r = lo_hi.scalar()
    x = F.col(col).cast("double")
    position = F.when(r["lo"] == r["hi"], F.lit(1)).otherwise(
        F.least(F.floor((x - r["lo"]) * bins / (r["hi"] - r["lo"])) + 1, F.lit(bins)))
    return (df.filter(F.col(col).isNotNull()).select(position.cast("int").alias("bin"))
            .groupBy("bin").agg(F.count("*").alias("n")))
