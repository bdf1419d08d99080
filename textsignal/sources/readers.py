"""Readers with fixed schemas and the fallbacks that a changing set of inputs needs."""
from functools import reduce

from pyspark.sql import functions as F, types as T

from textsignal.functions import text as X
from textsignal.sources.csv_splits import read_split_csv

FORUM_SCHEMA = T.StructType([T.StructField("post", T.StringType()), T.StructField("label", T.StringType())])
STRESS_SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("label", T.IntegerType())])
POST_SCHEMA = T.StructType([
    T.StructField("post_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()), T.StructField("source", T.StringType()),
])


def read_csv(spark, path, schema, na_columns=()):
    """CSV with header, quoted line breaks and a fixed schema; chosen columns get NA spellings nulled.

    Spark's own reader gives a file with quoted line breaks to one task. That serves files up to the size of a split; larger ones are read by splits.
    """
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).head()[0] or 0   # lists the files without opening them
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if largest > split:
        df = read_split_csv(spark, path, schema)
    else:
        df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return df.withColumns({c: X.null_if_na(F.col(c)) for c in na_columns})


def path_exists(spark, path):
    """True if the path exists on whatever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_or_empty(spark, path, schema, reader):
    """The source if it is there, else a typed empty table."""
    if path is not None and path_exists(spark, path):
        return reader(path)
    return spark.createDataFrame([], schema)


def read_first_existing(spark, paths):
    """The first Parquet table that exists, for stages that prefer an enriched input."""
    for path in paths:
        if path_exists(spark, path):
            return spark.read.parquet(path)
    raise FileNotFoundError(f"none of {paths}")


def union_splits(splits, tag="_split"):
    """Named splits under each other, each row tagged with its split."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def pick_column(df, names, position=None, default=None):
    """First column that exists by name, else by position, else a constant."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    if position is not None and position < len(df.columns):
        return F.col(df.columns[position])
    return F.lit(default).cast("string")


def spread(df):
    """Spread a table that arrives in fewer splits than there are cores, as a single small file does.
    Tables with enough splits are left alone, so nothing is shuffled at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < 2 * cores else df
