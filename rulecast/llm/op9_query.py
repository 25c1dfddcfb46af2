"""The query of near-duplicate classes, and the same rows in DuckDB SQL."""

from pyspark.sql import DataFrame, SparkSession

from rulecast.llm.common import table
from rulecast.llm.near_duplicates import near_duplicate_classes


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), shingle=2, percent=80)


OP9_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g
        FROM d) AS t
), n AS (
    SELECT d.doc_id, count(g) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY x, y
), link AS (
    SELECT x, y FROM common JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), reach(doc_id, r) AS (
    SELECT doc_id, doc_id FROM d UNION SELECT link.y, r FROM reach JOIN link ON link.x = reach.doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, min(r) AS component_id, min(r) = doc_id AS kept
FROM reach JOIN n USING (doc_id) GROUP BY doc_id, n
"""
