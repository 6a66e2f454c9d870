"""Query of the chat formatter and its SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.chat_format import format_conversations, loss_text, parse_turns
from tickspark.llm.common import table

PROBE = r"\### Assistant: </turn> ok"


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(i).cast("bigint").alias("turn"),
                 F.lit(role).alias("role"), F.lit(PROBE).alias("text"))
        for i, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    read = format_conversations(rows).select(
        "conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def _escaped(c: str, role: bool = False) -> str:
    text = rf"replace(replace(replace(replace({c}, '\', '\b'), '###', '\h'), '</turn>', '\t'), '<part>', '\p')"
    return rf"replace({text}, ':', '\c')" if role else text


OP4_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
marked AS (
  SELECT *, lag(role) OVER w IS NOT DISTINCT FROM role AS joined FROM rows
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_escaped('text')}) + CASE WHEN joined THEN 6 ELSE 4 + length({_escaped('role', True)}) + 2 + 8 END)
       AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id"""

QUERIES = {"op4_chat_format": op4_chat_format}
ORACLES = {"op4_chat_format": OP4_SQL}
