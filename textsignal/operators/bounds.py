"""Size checks that decide whether a side may be held in memory."""
from pyspark.sql import functions as F

from textsignal import config


def local_table(spark, columns, schema):
    """A parameter table from Python columns, planned as a local relation with a known size."""
    import pyarrow as pa
    return spark.createDataFrame(pa.table(columns), schema=schema)


def collect_bounded(df, max_rows=config.BROADCAST_ROWS):
    """Rows as an Arrow table if there are at most `max_rows`, else None."""
    table = df.limit(max_rows + 1).toArrow()
    return table if table.num_rows <= max_rows else None


def small_side(df, max_rows=config.BROADCAST_ROWS):
    """Evaluate a small derived table once and broadcast it.

    A table that turns out to have more rows is returned unchanged, so the join that
    uses it becomes an ordinary shuffled join and stays correct at any size.
    """
    table = collect_bounded(df, max_rows)
    if table is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))


def bind(df, **columns):
    """Add columns that are evaluated exactly once per row.

    A later filter on a plain computed column is pushed through the projection and repeats the
    expression; through a one-element generator it is not. Used for costly text expressions.
    """
    for name, column in columns.items():
        df = df.select("*", F.explode(F.array(column)).alias(name))
    return df


def keep_bound(df, name, column, condition):
    """Add a costly column and keep the rows where `condition(value)` holds, evaluating it once."""
    return df.select("*", F.explode(F.filter(F.array(column), condition)).alias(name))


def unnest(df, keep, array, name, pos=None):
    """One row per array element. The outer form plus a null filter keeps Spark from adding a size
    filter that would evaluate the array expression again."""
    gen = F.explode_outer(array).alias(name) if pos is None else F.posexplode_outer(array).alias(pos, name)
    return df.select(*keep, gen).filter(F.col(name).isNotNull())
