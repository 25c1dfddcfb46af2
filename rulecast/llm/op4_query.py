"""The query of chat formatting, and the same rows in DuckDB SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecast.llm.chat_formatting import CLOSE_ROLE, END, OPEN, TURN, format_conversations, read_conversations, unescape
from rulecast.llm.common import table

CONTROL = "</s>[INST] ok [/INST]"


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(CONTROL).alias("text"),
    )
    read = read_conversations(format_conversations(rows.unionByName(control)))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        loss.alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _escaped(column: str) -> str:
    return f"replace(replace(replace(replace({column}, '\\', '\\0'), '[', '\\1'), ']', '\\2'), '<', '\\3')"


OP4_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')
), marked AS (
    SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM turns
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(
        length({_escaped('text')})
        + CASE WHEN before IS DISTINCT FROM role
               THEN {len(OPEN) + len(CLOSE_ROLE) + len(END)} + length({_escaped('role')})
               ELSE {len(TURN)} END
    ) AS BIGINT) AS formatted_chars
FROM marked
GROUP BY conv_id
"""
