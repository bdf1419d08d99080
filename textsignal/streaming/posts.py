"""Clean, score and tag posts as files arrive.

The stages used here work within a row, so a streaming DataFrame passes through them unchanged and no
state is kept. Stages that group, rank or look at the whole table stay batch jobs.
"""
from pyspark.sql import functions as F

from textsignal import config
from textsignal.operators import entities, ingest, sentiment
from textsignal.sources.readers import POST_SCHEMA


def read_posts(spark, path, schema=POST_SCHEMA, max_files=None):
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def enrich(posts, lexicon, phrases=None):
    """Cleaned posts with sentiment columns and the entity map as JSON."""
    cleaned = ingest.clean_posts(posts.na.drop(subset=["text", "label"]))
    scored = sentiment.score(cleaned, lexicon)
    return entities.extract(scored, phrases).withColumn(
        "entities", entities.entity_json(F.col("entities")))


def write_posts(df, path, checkpoint):
    """Exactly-once Parquet sink; works off what is there and stops."""
    return (df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
