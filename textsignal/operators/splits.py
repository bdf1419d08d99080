"""Stratified splits and label codes."""
from pyspark.sql import Window as W, functions as F

from textsignal import config
from textsignal.functions import text as X
from textsignal.operators.bounds import small_side

BUCKET_CHARS = 4


def stratified_split(df, label, id_col, parts, rest="train", seed=config.SEED, name="split"):
    """Assign each row of each class to a part by its hash rank within the class, exactly.

    `parts` lists (name, share) in order: the first round(share·n) rows of a class by hash form the
    first part, and so on; what is left is `rest`.

    A class may hold most of the table, so it is never ranked in one task. The hash prefix cuts each
    class into up to 16⁴ even buckets; counts per bucket tell which bucket a cut falls into, only
    that bucket is ranked, and the cut becomes one hash value per class. Rows are then assigned in
    place by comparing their hash with it.
    """
    keyed = df.select(F.col(label).alias("_label"), F.concat_ws("/", X.row_hash(seed, id_col), F.col(id_col)).alias("_key"))
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, BUCKET_CHARS))
    by_bucket = W.partitionBy("_label").orderBy("_bucket")
    counts = (keyed.groupBy("_label", "_bucket").agg(F.count("*").alias("_n"))
              .withColumn("_upto", F.sum("_n").over(by_bucket))
              .withColumn("_all", F.sum("_n").over(W.partitionBy("_label"))))
    shares, total = [], 0.0
    for _, share in parts:
        total += share
        shares.append(round(total, 12))
    targets = F.array(*[F.struct(F.lit(i).alias("cut"), F.round(F.col("_all") * s).cast("long").alias("target"))
                        for i, s in enumerate(shares)])
    edges = (counts.withColumn("_t", F.explode(targets))
             .filter((F.col("_t.target") > F.col("_upto") - F.col("_n")) & (F.col("_t.target") <= F.col("_upto")))
             .select("_label", "_bucket", F.col("_t.cut").alias("_cut"),
                     (F.col("_t.target") - (F.col("_upto") - F.col("_n"))).alias("_rank")))
    # Few rows: one per class and cut.
    edges = small_side(edges)
    inside = W.partitionBy("_label", "_cut").orderBy("_key")
    cuts = (keyed.join(edges, ["_label", "_bucket"]).withColumn("_r", F.row_number().over(inside))
            .filter(F.col("_r") == F.col("_rank"))
            .groupBy("_label").agg(*[F.max(F.when(F.col("_cut") == i, F.col("_key"))).alias(f"_k{i}")
                                     for i in range(len(parts))]))
    out = (df.withColumn("_key", F.concat_ws("/", X.row_hash(seed, id_col), F.col(id_col)))
           .join(small_side(cuts).withColumnRenamed("_label", label), label, "left"))
    part = F.when(F.lit(False), F.lit(rest))
    for i, (part_name, _) in enumerate(parts):
        part = part.when(F.col("_key") <= F.col(f"_k{i}"), part_name)
    return out.withColumn(name, part.otherwise(rest)).drop("_key", *[f"_k{i}" for i in range(len(parts))])


def label_codes(df, label):
    """(label, code): alphabetical 0-based codes of the classes in the data."""
    classes = df.select(label).filter(F.col(label).isNotNull()).distinct()
    # One row per class; numbering them is a window over the class list, not over the data.
    return classes.withColumn("code", F.row_number().over(W.orderBy(label)) - 1)


def encode_labels(df, label, name="code"):
    return df.join(small_side(label_codes(df, label)).withColumnRenamed("code", name), label)


def decode_labels(df, codes, code="code"):
    """Class id → label name, from a label-map table."""
    return df.join(small_side(codes), code)
