"""Query of the whitened vectors; it has no SQL, the tests repeat it by brute force."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.common import table
from tickspark.llm.whitening import whiten


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLES = {}
