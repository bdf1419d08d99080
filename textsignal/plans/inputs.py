"""Inputs of the registered queries: the given tables, and text planted into them from their own ids.

The given prose has no forum noise, drugs, diagnoses or time phrases, so each row gets some, derived
from its columns, the same way in Spark and in SQL.
"""
from pyspark.sql import functions as F

from textsignal import vocab
from textsignal.plans.sql import lit
from textsignal.sources.readers import spread

TEXT_TABLES = ("documents", "conversations", "pages")

# Sample lexicons: small tables in the shape that the operators take. They claim no coverage.
LEXICON = {
    "good": 1.9, "great": 3.1, "happy": 2.7, "hope": 1.9, "hopeful": 2.3, "love": 3.2, "kind": 2.4,
    "sad": -2.1, "hate": -2.7, "terrible": -2.1, "worthless": -1.9, "pathetic": -2.7, "disgusting": -2.4,
    "stupid": -2.4, "idiot": -2.3, "no": -1.2, "license": 0.7, "is": 0.2, "was": -0.3,
}
LEMMAS = {"feeling": "feel", "feels": "feel", "mentioned": "mention", "idiots": "idiot", "was": "be", "licenses": "license",
          "reserved": "reserve", "rights": "right", "waiting": "wait", "things": "thing"}
TAGS = {"we": "PRP", "think": "VBP", "tired": "JJ", "worthless": "JJ", "each": "DT", "evening": "NN", "stupid": "JJ",
        "pathetic": "JJ", "idiot": "NN", "disgusting": "JJ", "license": "NN", "copyright": "NN", "reserved": "VBN"}
NAMES = {"the license": "MISC", "license": "MISC", "copyright": "ORG", "berlin": "LOC", "new york": "LOC",
         "new york times": "ORG", "doctor smith": "PER", "smith": "PER"}

MOODS = [
    "not very good but extremely stupid ", "i am so happy and kind of sad ",
    "never so good without doubt worthless ", "the least happy at least hopeful no good ",
    "hardly pathetic dont hate it ", "neither great nor no or love really really terrible ",
    "kind of sad but not disgusting at all ", "",
    "well he was kind of sad and just enough great or sort of x stupid ", "it is yeah right good the bomb is great and a broken heart hate to die for love x ",
]
TIMES = ["for the past 3 years i felt it ", "3 years ago ", "since may 2020 ", "for 2 months of this ", "since 20201 ",
         "10 days before ", ""]


def table(spark, sf_dir, name):
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in TEXT_TABLES else df


def choose(words, key):
    """Element of a list by a row's id."""
    return F.get(F.array(*[F.lit(w) for w in words]), (F.col(key) % len(words)).cast("int"))


def sql_choose(words, key):
    return f"([{', '.join(lit(w) for w in words)}])[{key} % {len(words)} + 1]"


def noisy_text():
    """Forum noise of every kind around the text."""
    return F.concat(F.lit("r/"), F.col("source"), F.lit(" u/user"), F.col("doc_id"), F.lit(" https://t.co/"), F.col("doc_id"),
                    F.lit(" [mine "), F.col("doc_id"), F.lit("](x) &amp; **"), F.col("lang"), F.lit("** "), F.col("text"),
                    F.lit(" r/cafés her/him [a](http://b.c/d) and (more) AT&T;x &#39; - www.foo.com) ~end~"))


SQL_NOISY = ("concat('r/', source, ' u/user', doc_id, ' https://t.co/', doc_id, ' [mine ', doc_id, '](x) &amp; **', lang, "
             "'** ', text, ' r/cafés her/him [a](http://b.c/d) and (more) AT&T;x &#39; - www.foo.com) ~end~')")


def moody_text():
    return F.concat(choose(MOODS, "doc_id"), F.col("text"))


SQL_MOODY = f"concat({sql_choose(MOODS, 'doc_id')}, text)"


def clinical_text():
    """A drug, two diagnoses that may nest or overlap, and a time phrase before the text; another drug and diagnosis behind it."""
    return F.concat(F.lit("took "), choose(vocab.MEDICATIONS, "doc_id"), F.lit(" for "), choose(vocab.DIAGNOSES, "doc_id"),
                    F.lit(" and social anxiety disorder then bipolar disorder "), choose(TIMES, "doc_id"),
                    F.lit("the new york times asked doctor smith "), F.col("text"), F.lit("\nlater "), choose(vocab.MEDICATIONS, "doc_id"),
                    F.lit(" for panic disorder in berlin "), choose(TIMES, "n_chars"))


SQL_CLINICAL = (f"concat('took ', {sql_choose(vocab.MEDICATIONS, 'doc_id')}, ' for ', {sql_choose(vocab.DIAGNOSES, 'doc_id')}, "
                f"' and social anxiety disorder then bipolar disorder ', {sql_choose(TIMES, 'doc_id')}, "
                "'the new york times asked doctor smith ', text, chr(10), 'later ', "
                f"{sql_choose(vocab.MEDICATIONS, 'doc_id')}, ' for panic disorder in berlin ', {sql_choose(TIMES, 'n_chars')})")


def longs(df):
    """Integer columns as BIGINT, so that counts, sizes and ranks have one type in every engine."""
    return df.select(*[F.col(f.name).cast("long") if f.dataType.simpleString() in ("int", "smallint") else F.col(f.name)
                       for f in df.schema.fields])


def joined(c):
    """A string array as one string, to compare results across engines."""
    return F.array_join(c, "|")
