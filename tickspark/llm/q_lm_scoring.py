"""Query of the language-model scores. Tests hold counts and base scores against plain Python."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.common import table
from tickspark.llm.language_id import fold
from tickspark.llm.lm_scoring import score


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (fold(F.col("doc_id"), 7) != 2).alias("train"))
    return score(docs, "train", table_bits=20, unit="grams").select(
        "doc_id", (fold(F.col("doc_id"), 7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
        "score", "bits_per_byte")


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
ORACLES: dict[str, str] = {}
