"""Bring sources to one schema, merge them, drop duplicates and unlabelled rows."""
from functools import reduce

from pyspark.sql import functions as F

from textsignal import vocab
from textsignal.functions import text as X
from textsignal.operators.bounds import keep_bound
from textsignal.sources.readers import pick_column
from textsignal.sources.writers import scratch_dir, stored, write_table


def from_forum(df, source, id_col=None):
    """Forum table → post schema. Text and label come by name, else from columns 0 and 1."""
    df, id_col = (df, id_col) if id_col else (_numbered(df), "_row_id")
    return df.select(
        F.col(id_col).cast("long").alias("post_id"),
        pick_column(df, ["post"], 0).cast("string").alias("text"),
        pick_column(df, ["label"], 1).cast("string").alias("label"),
        F.lit(source).alias("source"))


def _numbered(df):
    """Rows with generated ids, stored once: ids that are computed anew could differ after a retry."""
    path = scratch_dir(df.sparkSession, "numbered")
    write_table(df.withColumn("_row_id", F.monotonically_increasing_id()), path)
    return df.sparkSession.read.parquet(path)


def code_to_name(c, codes=None):
    """Integer code → name; a code outside the table, or null, becomes null."""
    codes = vocab.STRESS_CODES if codes is None else codes
    return X.lookup(c, codes)


def from_coded(df, source, codes=None, text="text", label="label", id_col=None):
    """Table with integer label codes → post schema."""
    df, id_col = (df, id_col) if id_col else (_numbered(df), "_row_id")
    return df.select(
        F.col(id_col).cast("long").alias("post_id"),
        F.col(text).cast("string").alias("text"),
        code_to_name(F.col(label), codes).cast("string").alias("label"),
        F.lit(source).alias("source"))


def union_sources(frames):
    """All sources under each other, with the rank that decides which copy of a text is kept."""
    ranked = [df.withColumn("source_rank", F.lit(i)) for i, df in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b), ranked)


def keep_first_copy(df, text="text", order=("source_rank", "post_id")):
    """Exact dedup on text, keeping the first row in `order` (which must identify a row).

    Copies are found on a 32-byte digest with a map-side minimum, so a text that makes up a
    third of the table still arrives as one row per task, and no text is sorted or grouped.
    Digests and keys are stored once; the rows lose those keys that are not the first of their digest, which are few
    where copies are, so that texts stay where they lie if the list of them is small enough to broadcast.
    """
    # Null texts are copies of each other.
    keys = stored(df.select(F.coalesce(F.unhex(F.sha2(F.col(text), 256)), F.unhex(F.lit(""))).alias("digest"), *order), "digests")
    key = F.struct(*order)
    first = keys.groupBy("digest").agg(F.min(key).alias("row_key"), F.count("*").alias("copies")).filter("copies > 1")
    lost = keys.join(first.select("digest", "row_key"), "digest").filter(key != F.col("row_key")).select(*order)
    return df.join(lost, list(order), "left_anti")


def merge_sources(frames):
    """Union → first copy of each text → rows with text and label.

    Duplicates go before nulls are dropped: an unlabelled first copy hides a later labelled one.
    """
    return keep_first_copy(union_sources(frames)).na.drop(subset=["text", "label"])


def clean_posts(df, text="text"):
    """Add `text_clean_deep` and drop posts that cleaning left blank."""
    return keep_bound(df, "text_clean_deep", X.clean_deep(F.col(text)), lambda t: ~X.is_blank(t))


def value_counts(df, *cols):
    return df.groupBy(*cols).count().orderBy(F.desc("count"), *cols)
