"""Query of the centroid clustering and its SQL, a chain of rounds over plain integers."""

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.centroid_clustering import cluster
from tickspark.llm.common import table

ROUNDS = 5


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"), rounds=ROUNDS)


def _assign(i: int) -> str:
    return f"""a{i} AS MATERIALIZED (
  SELECT vec_id, x, unnest(near, recursive := true) FROM (
    SELECT v.vec_id, v.x, min({{'distance': CAST(list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT),
      'cluster': c.cluster}}) AS near
    FROM v CROSS JOIN c{i} c GROUP BY v.vec_id, v.x))"""


def _update(i: int) -> str:
    return f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT cluster, list(m ORDER BY d) AS x FROM (
      SELECT cluster, d, CAST(floor_div AS BIGINT) AS m FROM (
        SELECT cluster, d, (sum(e) - ((sum(e) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
        FROM (SELECT cluster, unnest(x) AS e, generate_subscripts(x, 1) AS d FROM a{i}) GROUP BY cluster, d))
    GROUP BY cluster) m USING (cluster))"""


OP11_SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * e::DOUBLE) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, x
  FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v ORDER BY h LIMIT 40)),
""" + ",\n".join(f"{_assign(i)},\n{_update(i)}" for i in range(ROUNDS)) + f""",
{_assign(ROUNDS)}
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (cluster)"""

QUERIES = {"op11_centroid_clustering": op11_centroid_clustering}
ORACLES = {"op11_centroid_clustering": OP11_SQL}
