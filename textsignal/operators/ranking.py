"""Best rows per query."""
from pyspark.sql import Window as W, functions as F


def top_k(scored, k, query="query_id", idx="idx", score="score", rank="rank"):
    """Best k rows per query. Spark keeps k per query and task before the exchange."""
    w = W.partitionBy(query).orderBy(F.desc(score), idx)
    return scored.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
