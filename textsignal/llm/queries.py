"""Registered queries of the subpackage: each operator over its whole table."""
from pyspark.sql import functions as F

from textsignal.llm import balltree, bpe, decontaminate, licenses, negatives, pages, passages, pii, prefixes, quality, secrets, simhash, suffixes
from textsignal.llm.common import registry, written

QUERIES, SQL, query = registry()


def documents(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def labels(spark, d):
    return spark.read.parquet(f"{d}/labels.parquet")


def span_text(spans):
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans, kind):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def quality_model(spark, docs, d):
    """The model of the labels outside the held-out third."""
    known = labels(spark, d)
    return quality.fit(docs, known.filter(~quality.held_out("doc_id")))


@query()
def op1_pii(spark, d):
    found = pii.scan(documents(spark, d).select("doc_id", "text")).drop("text")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    scores = F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",")
    return found.select("doc_id", *[count_kind("pii", k) for k in pii.BASE], F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("pii")).alias("spans"), scores.alias("scores"))


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op2_topk(spark, d):
    points = balltree.scaled(spark.read.parquet(f"{d}/embeddings.parquet"))
    return balltree.top_k(points, points.filter("vec_id % 50 = 0"), 5)


@query()
def op3_pages(spark, d):
    return pages.main_text(spark.read.parquet(f"{d}/pages.parquet"))


@query()
def op4_decontamination(spark, d):
    marked = decontaminate.mark(documents(spark, d).select("doc_id", "text"), spark.read.parquet(f"{d}/benchmark.parquet"))
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query()
def op5_quality(spark, d):
    docs = documents(spark, d).select("doc_id", "text")
    scored = quality.score(docs, quality_model(spark, docs, d)).drop("text")
    return scored.select("doc_id", quality.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op6_suffixes(spark, d):
    return suffixes.cut_repeats(documents(spark, d).select("doc_id", "text"))


@query()
def op7_licenses(spark, d):
    return licenses.listed(documents(spark, d))


@query()
def op8_secrets(spark, d):
    found = secrets.scan(documents(spark, d).select("doc_id", "text")).drop("text")
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select("doc_id", *[count_kind("secrets", k) for k in secrets.BASE], F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"))


@query()
def op9_simhash(spark, d):
    grouped = simhash.group(documents(spark, d))
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query()
def op10_bpe(spark, d):
    import public_tokenizers
    coded = bpe.digests(documents(spark, d).select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query(r"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
     FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id FROM o),
h AS (SELECT conv_id, xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, (d & 1) * 3988292384)), 4294967295)) % 4 AS h FROM c),
t AS (SELECT h.conv_id, o.p, o.role, o.text FROM h JOIN o ON o.conv_id = h.conv_id - h.conv_id % 20 AND o.p <= h.h
      UNION ALL SELECT h.conv_id, o.p + 10, o.role, o.text FROM h JOIN o ON o.conv_id = h.conv_id AND o.p > h.h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY p) AS depth, md5(length(role) || ':' || role || text) AS id,
        len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t),
m AS (SELECT conv_id, depth, words, md5(string_agg(id, ',') OVER (PARTITION BY conv_id ORDER BY depth)) AS node FROM r
      UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
n AS (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(words) AS words, count(*) AS n_convs FROM m GROUP BY node),
e AS (SELECT n.*, p.node AS parent FROM n LEFT JOIN m p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
k AS (SELECT parent, count(*) AS n_children FROM e WHERE parent IS NOT NULL GROUP BY parent),
s AS (SELECT a.node, sum((u.n_convs - 1) * u.words) AS saved_tokens, count(*) FILTER (k.parent IS NULL) AS n_leaves
      FROM e u JOIN m a ON a.conv_id = u.conv_id AND a.depth <= u.depth LEFT JOIN k ON k.parent = u.node GROUP BY a.node),
z AS (SELECT node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha FROM (SELECT conv_id, arg_max(node, depth) AS node FROM m GROUP BY conv_id) GROUP BY node)
SELECT e.conv_id, e.depth, p.conv_id AS parent_conv_id, e.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
  coalesce(z.sha, sha256('')) AS ends_sha256
FROM e JOIN s USING (node) LEFT JOIN n p ON p.node = e.parent LEFT JOIN k ON k.parent = e.node LEFT JOIN z ON z.node = e.node""")
def op11_prefixes(spark, d):
    turns = written(prefixes.turns(spark.read.parquet(f"{d}/conversations.parquet")), "numbered")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(4))
    rebuilt, convs = prefixes.branched(turns, F.col("conv_id") - F.col("conv_id") % 20, head, 3)
    return prefixes.trie(written(rebuilt, "rebuilt"), convs)


@query(r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM w),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
hit AS (SELECT doc_id, i FROM h JOIN f USING (h) WHERE doc_id > first),
x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
g AS (SELECT x.doc_id, x.i, x.word, max(hit.i) OVER (PARTITION BY x.doc_id ORDER BY x.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
      FROM x LEFT JOIN hit ON hit.doc_id = x.doc_id AND hit.i = x.i),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""")
def op12_passages(spark, d):
    kept = passages.cut_passages(documents(spark, d))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5""")
def op13_negatives(spark, d):
    points = negatives.whole_numbers(spark.read.parquet(f"{d}/embeddings.parquet"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(points.withColumn("label", moved), F.col("vec_id") % 100 == 0)
