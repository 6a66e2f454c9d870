"""Query of the mixer. SQL has no permutations, so tests replay the mix."""

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.common import table
from tickspark.llm.mixing import plan_mix


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = plan_mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op9_mixing": op9_mixing}
ORACLES: dict[str, str] = {}
