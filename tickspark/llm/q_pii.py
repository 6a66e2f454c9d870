"""Query of the sanitiser. Tests hold its base spans and ratios against plain Python."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.common import table
from tickspark.llm.pii import KINDS, find_spans


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(_written(of(*KINDS)), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


QUERIES = {"op1_pii": op1_pii}
ORACLES: dict[str, str] = {}
