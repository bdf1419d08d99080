"""Row ids, samples and fallbacks."""
from pyspark.sql import Window as W, functions as F

from textsignal import config
from textsignal.functions import text as X
from textsignal.operators.bounds import collect_bounded, local_table
from textsignal.sources import writers


def dense_index(df, *order, name="idx", ranges=None):
    """Dense 0-based position in the order of some columns of any type, which must identify a row, without sorting in one task.

    Rows are cut into ranges and stored with the number of their range, numbered inside it, and shifted by the number of
    rows in the ranges before; `ranges` defaults to the session's shuffle partitions.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = writers.scratch_dir(spark, "ranges")
    writers.write_table(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), path)
    ranged = spark.read.parquet(path)
    # One row per range, and the number of ranges is fixed above.
    counts = collect_bounded(ranged.groupBy("_range").agg(F.count("*").alias("n")), ranges + 1).to_pydict()
    sizes = dict(zip(counts["_range"], counts["n"]))
    offsets, total = {"_range": [], "_before": []}, 0
    for r in sorted(sizes):
        offsets["_range"].append(r)
        offsets["_before"].append(total)
        total += sizes[r]
    before = local_table(spark, offsets, "_range int, _before long")
    in_range = F.row_number().over(W.partitionBy("_range").orderBy(*order)).cast("long") - 1
    return (ranged.join(F.broadcast(before), "_range")
            .withColumn(name, F.col("_before") + in_range).drop("_range", "_before"))


def sample_n(df, n, id_col, seed=config.SEED):
    """Reproducible sample of n rows: the n smallest row hashes. A table with fewer rows is refused."""
    there = df.limit(n).count()
    if there < n:
        raise ValueError(f"a sample of {n} rows of {there}")
    return (df.withColumn("_h", X.row_hash(seed, id_col)).orderBy("_h", id_col).limit(n).drop("_h"))


def first_n(df, n, id_col):
    return df.orderBy(id_col).limit(n)


def or_fallback(attempt, default):
    """Value of an expression that yields null on failure, else the default."""
    return F.coalesce(attempt, default)
