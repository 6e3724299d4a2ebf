"""One query per operator over its whole table, and the SQL that gives the same rows where SQL can."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm import fingerprints, hyperminhash, importance, language_id, license_scan, line_dedup, mixing, ngram_join, packing, secrets, suffix_dedup, vector_search, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < secrets.BASE)

    def of(kind: int) -> F.Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    count = [of(i).alias(f"n_{k[0]}") for i, k in enumerate(secrets.KINDS[:secrets.BASE])]
    return found.select("doc_id", *count, F.sha2(secrets.as_text(base), 256).alias("base_sha256"), secrets.as_text(F.col("spans")).alias("spans"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~_held_out()))
    out = language_id.detect(docs.select("doc_id", "text"), model)
    return out.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, min_words=line_dedup.ANY_WORDS)
    return out.select("doc_id", F.size("kept").cast("long").alias("n_kept"), "n_removed", F.sha2(F.concat_ws("\n", "kept"), 256).alias("kept_sha256"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))
    return out.select(
        F.col("k").alias("doc_id"), F.col("n").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text("f").alias("fingerprint"), fingerprints.as_text("fe").alias("edited_fingerprint"),
        fingerprints.likeness("f", "fe").alias("near_edited"), fingerprints.likeness("f", "next_f").alias("near_next"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.groups(_table(spark, sf_dir, "documents"), k=4, percent=85)
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_documents(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings")
    return vector_search.top_k(table, F.col("vec_id") % 50 == 0, k=5)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(F.col("key").alias("doc_id"), "n_features", "weight", "score", "rank")


def op12_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hyperminhash.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)
    return out.select(F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), F.col("doc").eqNullSafe(F.col("component")).alias("kept"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(_table(spark, sf_dir, "embeddings"))
    return out.select(F.col("key").alias("vec_id"), "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained", "identity_error")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_secret_scan, op3_language_id, op4_line_dedup, op5_fingerprints, op6_ngram_join, op7_mixing, op8_vector_search, op9_packing, op10_suffix_dedup, op11_importance_resampling, op12_hyperminhash, op13_embedding_whitening, pipeline)}

_WORDS = r"list_filter(string_split(translate(coalesce(text, ''), chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '     '), ' '), lambda w: w <> '')"


def _components_sql(k: int, more: str = "") -> str:
    """Documents by the smallest one they reach over links of 85 % on ``k``-word shingles."""
    return f"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, list_transform({_WORDS}, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i+{k - 1}], ' '))) END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, md5(unnest(s)) AS x FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
k AS MATERIALIZED (SELECT c.a, c.b FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
l AS MATERIALIZED (SELECT a, b FROM k UNION ALL SELECT b, a FROM k),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.root) AS component_id{more} FROM s JOIN r ON r.node = s.doc_id GROUP BY s.doc_id, s.s
"""


OP6_SQL = _components_sql(4)
OP12_SQL = _components_sql(3, ", s.doc_id = min(r.root) AS kept")

OP7_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
f AS (SELECT 0 AS i, 0.0::DOUBLE AS level, -1::BIGINT AS capped
  UNION ALL
  SELECT i + 1, (SELECT sum(ss) - sum(CASE WHEN w * level >= 3 * ss THEN 3 * ss ELSE 0 END) FROM t)::DOUBLE / (SELECT sum(w) FROM t WHERE NOT w * level >= 3 * ss),
         (SELECT count(*) FROM t WHERE w * level >= 3 * ss)
  FROM f WHERE capped <> (SELECT count(*) FROM t WHERE w * level >= 3 * ss) AND EXISTS (SELECT 1 FROM t WHERE NOT w * level >= 3 * ss)),
g AS (SELECT source, ss, round(least(w * (SELECT arg_max(level, i) FROM f), CAST(3 * ss AS DOUBLE)), 6) AS target FROM t),
p AS (SELECT *, CASE WHEN ss > 0 THEN CAST(floor(target / ss) AS BIGINT) ELSE 0 END AS q FROM g),
o AS (SELECT d.*, ss, target, q, target - q * ss AS rest, sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER (PARTITION BY d.source, h) AS here FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, CAST(ss AS BIGINT) AS source_size, target,
       CAST(size * (q + CASE WHEN rest <= 0 THEN 0 WHEN upto <= rest THEN 1 WHEN upto - here > rest THEN 0 WHEN abs(upto - rest) < abs(upto - here - rest) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM o
"""

OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP11_SQL = f"""
WITH t AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
w AS MATERIALIZED (
  SELECT 0 AS side, row_number() OVER () AS id, doc_id, {_LETTERS} AS w FROM documents
  UNION ALL
  SELECT 1, 0, item_id, {_LETTERS} FROM benchmark),
o AS MATERIALIZED (SELECT side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM w),
h AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM o)),
c AS MATERIALIZED (SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b FROM h, t),
n AS (SELECT b, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM o JOIN c USING (f) GROUP BY b),
g AS (SELECT b, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST((SELECT sum(s) FROM n) AS DOUBLE) + 10000) / ((CAST(s AS DOUBLE) + 1) * (CAST((SELECT sum(t) FROM n) AS DOUBLE) + 10000)))) AS BIGINT) AS g FROM n),
m AS (SELECT id, count(*) AS n, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM o JOIN c USING (f) JOIN g USING (b) WHERE side = 0 GROUP BY id),
d AS (SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(m, 0) AS weight,
             coalesce(m, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4294967296))) AS BIGINT) AS score
      FROM w LEFT JOIN m USING (id) WHERE side = 0),
r AS (SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS FIRST, n_features, words) END AS r FROM d)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, score, CASE WHEN r <= (SELECT count(*) * 25 // 100 FROM d WHERE words >= 20) THEN CAST(r AS BIGINT) END AS rank FROM r
"""

ORACLE = {"op8_vector_search": OP8_SQL, "op6_ngram_join": OP6_SQL, "op7_mixing": OP7_SQL, "op11_importance_resampling": OP11_SQL, "op12_hyperminhash": OP12_SQL}
