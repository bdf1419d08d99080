"""Cleaning pipeline over `documents`: quality, near copies, benchmark passages, personal data, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before kept, and returns a frame that
`run` writes as Parquet and reads again. All stages but the last return the columns they were given.
"""
import public_tokenizers
from pyspark.sql import functions as F

from textsignal.llm import bpe, decontaminate, pii, quality, simhash
from textsignal.llm.common import written


def keep_good(spark, docs, sf_dir):
    """Rows whose quality score is at least a half. Null and empty texts score 0 and go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~quality.held_out("doc_id"))
    model = quality.fit(docs, labels)
    return quality.score(docs, model, name="_quality").filter("_quality >= 0.5").select(*docs.columns)


def drop_near_copies(spark, docs, sf_dir):
    """One row of each group of near copies: the one with the smallest id."""
    return simhash.one_of_each(docs)


def drop_benchmark(spark, docs, sf_dir):
    """Rows that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.mark(docs, benchmark, name="_leaks").filter(F.size("_leaks") == 0).select(*docs.columns)


def redact_personal_data(spark, docs, sf_dir):
    """All rows, with personal data replaced by its kind and the number of characters brought up to date."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def tokenise(spark, docs, sf_dir):
    """Number and digest of each row's tokens, and the digest of the text decoded from them."""
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.digests(docs.select("doc_id", "text"), path, pattern).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark),
    ("pii", redact_personal_data),
    ("byte_level_bpe", tokenise),
]

# A trained classifier, fingerprints and merges have no SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Rows of the last stage over all of `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
