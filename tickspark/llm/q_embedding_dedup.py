"""Query of the near-duplicate vectors. Its SQL finds links and components by brute force."""

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.common import table
from tickspark.llm.embedding_dedup import near_duplicates


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (
  SELECT u AS node, u AS top FROM links
  UNION SELECT l.v, r.top FROM reach r JOIN links l ON l.u = r.node),
tops AS (SELECT node, min(top) AS top FROM reach GROUP BY node),
counts AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(t.top, e.vec_id) AS component_id,
  e.vec_id = coalesce(t.top, e.vec_id) AS kept
FROM embeddings e LEFT JOIN tops t ON t.node = e.vec_id LEFT JOIN counts c ON c.u = e.vec_id"""

QUERIES = {"op5_embedding_dedup": op5_embedding_dedup}
ORACLES = {"op5_embedding_dedup": OP5_SQL}
