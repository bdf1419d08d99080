"""Registered queries: sources, sinks, merging, row functions."""
from pyspark.sql import functions as F, types as T

from textsignal import vocab
from textsignal.functions import text as X
from textsignal.operators import features as FE, ingest, rows
from textsignal.plans import sql as S
from textsignal.plans.inputs import joined, longs, table
from textsignal.sources import readers, writers

QUERIES, SQL = {}, {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return register


def posts(spark, d):
    """Conversation turns as the first source, documents with their 0/1 code as the second."""
    turns = table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("text").alias("post"), F.col("role").alias("label"))
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return ingest.merge_sources([ingest.from_forum(turns, "forum", "id"),
                                 ingest.from_coded(docs, "stress", label="toxic", id_col="doc_id")])


SQL_POSTS = """
u AS (SELECT conv_id * 1000 + turn AS post_id, text, role AS label, 'forum' AS source, 0 AS source_rank FROM conversations
      UNION ALL
      SELECT d.doc_id, d.text, CASE l.toxic WHEN 0 THEN 'not_stressed' WHEN 1 THEN 'stress' END, 'stress', 1
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY source_rank, post_id) AS rn FROM u),
posts AS (SELECT post_id, text, label, source FROM r WHERE rn = 1 AND text IS NOT NULL AND label IS NOT NULL)"""


@query(f"""WITH {SQL_POSTS}, c AS (SELECT label, source, {S.deep('text')} AS t FROM posts)
SELECT label, source, count(*) AS n FROM c WHERE trim(t) <> '' GROUP BY label, source""")
def clean_label_counts(spark, d):
    return ingest.clean_posts(posts(spark, d)).groupBy("label", "source").agg(F.count("*").alias("n"))


@query(f"WITH {SQL_POSTS} SELECT post_id, label, source, md5(text) AS text_md5 FROM posts")
def merge_dedup(spark, d):
    return posts(spark, d).select("post_id", "label", "source", F.md5("text").alias("text_md5"))


@query("""SELECT CASE WHEN quality = 1 THEN 'train' ELSE 'test' END AS _split, toxic::BIGINT AS toxic, count(*) AS n
FROM labels GROUP BY ALL""")
def multi_split_union(spark, d):
    labels = table(spark, d, "labels")
    splits = {"train": labels.filter("quality = 1"), "test": labels.filter("quality = 0")}
    return longs(readers.union_splits(splits).groupBy("_split", "toxic").agg(F.count("*").alias("n")))


@query("SELECT 'stress' AS source, count(*) AS n FROM (SELECT DISTINCT text FROM documents) WHERE text IS NOT NULL")
def optional_source_fallback(spark, d):
    missing = readers.read_or_empty(spark, f"{d}/no_such_forum_export", readers.FORUM_SCHEMA, spark.read.parquet)
    docs = table(spark, d, "documents").withColumn("code", F.lit(1))
    merged = ingest.merge_sources([ingest.from_forum(missing, "forum"),
                                   ingest.from_coded(docs, "stress", label="code", id_col="doc_id")])
    return merged.groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def enriched_else_base(spark, d):
    df = readers.read_first_existing(spark, [f"{d}/documents_enriched.parquet", f"{d}/documents.parquet"])
    return df.groupBy("source").agg(F.count("*").alias("n"))


NA_SAMPLE = ["", "nan", "NA", "null", "None", "n/a", "none", "ok"]


@query(f"""WITH t AS (SELECT doc_id, ([{', '.join(S.lit(x) for x in NA_SAMPLE)}])[doc_id % 8 + 1] AS raw, source FROM documents)
SELECT doc_id, CASE WHEN raw NOT IN {S.in_list(vocab.NA_TOKENS)} THEN raw || source END AS value FROM t""")
def na_normalise(spark, d):
    raw = F.get(F.array(*[F.lit(x) for x in NA_SAMPLE]), (F.col("doc_id") % 8).cast("int"))
    return (table(spark, d, "documents").select("doc_id", X.null_if_na(raw).alias("v"), "source")
            .select("doc_id", F.concat("v", "source").alias("value")))


@query("""SELECT doc_id, text AS by_name, lang AS by_position, 'unknown' AS by_default FROM documents""")
def column_fallback(spark, d):
    df = table(spark, d, "documents")
    return df.select("doc_id", readers.pick_column(df, ["post", "text"], 0).alias("by_name"),
                     readers.pick_column(df, ["label"], 2).alias("by_position"),
                     readers.pick_column(df, ["topic"], default="unknown").alias("by_default"))


@query("SELECT doc_id, md5(text) AS text_md5, lang, source FROM documents")
def csv_round_trip(spark, d):
    path = writers.scratch_dir(spark, "documents-csv")
    writers.write_table(table(spark, d, "documents").select("doc_id", "text", "lang", "source"), path, "csv")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])
    return readers.read_csv(spark, path, schema).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


@query("""SELECT CASE toxic WHEN 0 THEN 'not_stressed' WHEN 1 THEN 'stress' END AS name, quality::VARCHAR AS quality, count(*) AS n
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY ALL""")
def label_code_map(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return (df.select(ingest.code_to_name(F.col("toxic")).alias("name"), F.col("quality").cast("string").alias("quality"))
            .groupBy("name", "quality").agg(F.count("*").alias("n")))


@query("SELECT doc_id, source FROM (SELECT doc_id, source FROM documents ORDER BY md5('42-' || doc_id), doc_id LIMIT 200)")
def sample_n(spark, d):
    return rows.sample_n(table(spark, d, "documents").select("doc_id", "source"), 200, "doc_id")


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 500")
def first_n(spark, d):
    return rows.first_n(table(spark, d, "documents").select("doc_id", "lang"), 500, "doc_id")


@query(f"WITH {SQL_POSTS} SELECT post_id, source, row_number() OVER (ORDER BY post_id, source) - 1 AS idx FROM posts")
def dense_row_id(spark, d):
    return rows.dense_index(posts(spark, d).select("post_id", "source"), "post_id", "source")


@query(f"""WITH t AS (SELECT doc_id, text, {S.tokens('text')} AS tk FROM documents)
SELECT doc_id, replace(substring(text, 1, 200), chr(10), ' ') AS snippet, substring(text, 1, 80) AS c80,
       md5(array_to_string(tk[1:900], ' ')) AS words900, len(tk[1:512]) AS n512 FROM t""")
def truncations(spark, d):
    df = table(spark, d, "documents")
    return longs(df.select("doc_id", X.snippet(F.col("text")).alias("snippet"), X.head_chars(F.col("text"), 80).alias("c80"),
                           F.md5(X.head_words(F.col("text"), 900)).alias("words900"),
                           F.size(X.head_tokens(X.tokenize(F.col("text"), "whitespace"), 512)).alias("n512")))


@query("""SELECT doc_id, coalesce(TRY_CAST(CASE WHEN n_chars % 3 = 0 THEN n_chars::VARCHAR ELSE substring(text, 1, 5) END AS BIGINT), -1)
AS value FROM documents""")
def row_failure_fallback(spark, d):
    raw = F.when(F.col("n_chars") % 3 == 0, F.col("n_chars").cast("string")).otherwise(F.substring("text", 1, 5))
    return table(spark, d, "documents").select("doc_id", rows.or_fallback(raw.try_cast("long"), F.lit(-1)).alias("value"))


@query("""SELECT 'documents' AS name, count(*) AS n_rows, 5::BIGINT AS n_cols FROM documents""")
def row_column_counts(spark, d):
    return longs(FE.row_counts(table(spark, d, "documents")).select(F.lit("documents").alias("name"), "n_rows", "n_cols"))


@query("SELECT lang, count(*) AS count FROM documents GROUP BY lang")
def class_counts(spark, d):
    return ingest.value_counts(table(spark, d, "documents"), "lang")


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL ORDER BY source")
def distinct_classes(spark, d):
    return FE.distinct_values(table(spark, d, "documents"), "source")


@query("""SELECT '{' || string_agg('"' || lang || '":' || n, ',' ORDER BY lang) || '}' AS json
FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang)""")
def json_report(spark, d):
    return writers.map_json(table(spark, d, "documents").groupBy("lang").agg(F.count("*").alias("n")), "lang", "n")


@query("SELECT (row_number() OVER (ORDER BY source) - 1) AS id, source AS label FROM (SELECT DISTINCT source FROM documents)")
def json_label_map(spark, d):
    from textsignal.operators.splits import label_codes
    codes = label_codes(table(spark, d, "documents"), "source")
    path = writers.scratch_dir(spark, "label-map")
    writers.write_table(writers.map_json(codes, "code", "source"), path, "json")
    back = spark.read.schema("json string").json(path)
    return longs(writers.read_int_map(back))
