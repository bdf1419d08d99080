"""Sinks for tables, small JSON reports and vector tables."""
from pyspark.sql import functions as F

from textsignal import config


def write_table(df, path, fmt="parquet", partition_by=None, salts=8):
    """Overwrite a stage table. Rows of a partition value are gathered in `salts` tasks, so that no task writes a file to every folder. CSV gets a header and doubled quotes, so it reads back unchanged."""
    writer = df.write.mode("overwrite")
    if partition_by:
        # The salt comes from the whole row, so a value with a third of all rows is spread too.
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).alias("_salt")
        placed = df.select("*", salt).repartition(F.col(partition_by), F.col("_salt")).drop("_salt")
        writer = placed.write.mode("overwrite").partitionBy(partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_bucketed(df, table, key, buckets):
    """Stage table hashed by the post key: later per-post groupings and joins need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def map_json(df, key, value, max_rows=config.BROADCAST_ROWS):
    """A small report table (one row per topic, metric or class) as one JSON object; a table of more than `max_rows` rows is refused."""
    if df.limit(max_rows + 1).count() > max_rows:
        raise ValueError(f"a JSON report of more than {max_rows} rows")
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("key"),
                                                   F.col(value).alias("value"))))
    return df.agg(F.to_json(F.map_from_entries(entries)).alias("json"))


def read_int_map(df, column="json"):
    """Inverse of map_json for an id → label object: rows (id INT, label STRING)."""
    parsed = F.from_json(F.col(column), "map<string,string>")
    return df.select(F.explode(parsed).alias("k", "label")).select(F.col("k").cast("int").alias("id"), "label")


def scratch_dir(spark, name):
    """A folder every executor can reach: the cluster's checkpoint folder. A temporary one serves in local mode only;
    elsewhere a session without such a folder is refused, since executors would write to disks of their own."""
    import os
    import tempfile
    import uuid
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="textsignal-")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def stored(df, name):
    """Write a frame to a scratch folder and read it back: what made it runs once, and its lineage ends there."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
