"""The query of importance resampling towards the benchmark, and the same rows in DuckDB SQL."""

from pyspark.sql import DataFrame, SparkSession

from rulecast.llm.common import table
from rulecast.llm.crc_sql import CRC_TABLE, crc32_sql
from rulecast.llm.target_resampling import resample_towards


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample_towards(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12_SQL = f"""
WITH {CRC_TABLE}, d AS (SELECT doc_id, {_WORDS} AS w FROM documents
), b AS (SELECT {_WORDS} AS w FROM benchmark
), counted AS (
    SELECT doc_id, f, count(*) AS n FROM (
        SELECT doc_id, unnest(w) AS f FROM d
        UNION ALL SELECT doc_id, w[i] || ' ' || w[i + 1] FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d) AS x) AS y
    GROUP BY doc_id, f
), wanted AS (
    SELECT f, count(*) AS n FROM (
        SELECT unnest(w) AS f FROM b
        UNION ALL SELECT w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM b) AS x) AS y
    GROUP BY f
), buckets AS (
    SELECT f, {crc32_sql("f")} % 10000 AS bucket FROM (SELECT f FROM counted UNION SELECT f FROM wanted) AS x, crc_table
), s AS (SELECT bucket, sum(n) AS s FROM counted JOIN buckets USING (f) GROUP BY bucket
), t AS (SELECT bucket, sum(n) AS t FROM wanted JOIN buckets USING (f) GROUP BY bucket
), gains AS (
    SELECT bucket, floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) FROM s) + 10000)
        / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * ((SELECT CAST(coalesce(sum(t), 0) AS DOUBLE) FROM t) + 10000)))) AS gain
    FROM range(10000) AS r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), means AS (
    SELECT doc_id, sum(n) AS n, floor(sum(n * gain) / sum(n)) AS weight
    FROM counted JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY doc_id
), scored AS (
    SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM d LEFT JOIN means USING (doc_id)
), ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
