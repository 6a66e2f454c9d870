"""Query of the exact duplicates and its SQL."""

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.common import table
from tickspark.llm.exact_dedup import exact_duplicates


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1 AS kept, sha256(text) AS text_sha256
FROM t"""

QUERIES = {"op13_exact_dedup": op13_exact_dedup}
ORACLES = {"op13_exact_dedup": OP13_SQL}
