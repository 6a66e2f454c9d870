"""Query of language identification. Tests check held-out accuracy and calibration."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.common import table
from tickspark.llm.language_id import fit, fold, predict


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = fit(docs.where(~held_out))
    read = docs.select("doc_id", "text", held_out.alias("held_out"))
    return predict(read, model).select("doc_id", "held_out", "lang_pred", "score")


QUERIES = {"op7_language_id": op7_language_id}
ORACLES: dict[str, str] = {}
