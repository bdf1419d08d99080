"""Connected components of a link table by alternating star contraction."""
from pyspark.sql import functions as F

from textsignal.llm.common import written


def _smallest(rows):
    """Each node with the smallest of its partners, or itself."""
    return written(rows.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "smallest")


def components(links):
    """(node, root) for every node of `links` (a, b): root is the smallest node that can be reached.

    A large-star step hangs the larger partners of a node on its smallest one, a small-star step the
    smaller ones; both only take minima, so a node with any number of partners never meets them in one
    task: the joins are between written tables, whose large partitions can be split. Steps are repeated
    until no link changes. Null and self links are dropped.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links, before = written(links.distinct(), "links"), None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = links.union(links.select("b", "a"))
        large = both.join(_smallest(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large")
        least = _smallest(large)
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
