"""Query of the line deduplication. Tests hold it against a replay in plain Python."""

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm.common import table
from tickspark.llm.line_dedup import dedup_lines


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op10_line_dedup": op10_line_dedup}
ORACLES: dict[str, str] = {}
