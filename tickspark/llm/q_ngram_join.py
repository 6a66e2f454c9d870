"""Query of the n-gram join. Tests hold it against all pairs."""

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.common import table
from tickspark.llm.ngram_join import near_duplicates


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op6_ngram_join": op6_ngram_join}
ORACLES: dict[str, str] = {}
