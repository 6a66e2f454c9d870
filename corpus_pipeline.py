"""A training corpus from ``documents``: language, repeated lines, near duplicates, source mix, packed sequences.

Each stage takes what its predecessor kept, as a table, and all but the last return the columns of documents. Texts that
stages change get a new ``n_chars``. The last returns token pieces with their sequence and place.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.llm.common import fitting_name, stored
from tickspark.llm.language_id import fit, fold, predict
from tickspark.llm.line_dedup import dedup_lines
from tickspark.llm.mixing import mixed_documents
from tickspark.llm.ngram_join import near_duplicates
from tickspark.llm.packing import pack, token_pieces

#: A text is rejected if it has no letter, or if the model is less sure of the best language than this.
LEAST_SURE = 0.4


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows; the others are rejected."""
    pred, sure = fitting_name(docs, "lang_pred"), fitting_name(docs, "lang_score")
    judged = predict(docs, fit(docs.where(fold(F.col("doc_id"), 5) != 0)), pred=pred, score=sure)
    return judged.where((F.col(pred) != "und") & (F.col(sure) >= LEAST_SURE)).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; documents that were nothing else go."""
    lines, deleted = fitting_name(docs, "n_lines"), fitting_name(docs, "n_deleted")
    cut = dedup_lines(docs, n_lines=lines, n_deleted=deleted)
    return _counted(cut.where((F.col(deleted) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    name, hashed = F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("h")
    found = stored(near_duplicates(docs.select(F.struct(name, hashed).alias("k"), "text"), key="k").select("k", "kept", "n_links"), "near")
    drop = found.where(~F.col("kept")).select(F.col("k.doc_id").alias("_id"), F.col("k.h").alias("_h"))
    left = docs.join(drop, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h")), "left_anti")
    repeated = found.where("kept AND n_links > 0").groupBy("k").count().where("count > 1")
    if repeated.isEmpty():
        return left
    mark = fitting_name(docs, "text_hash")
    return left.withColumn(mark, hashed).dropDuplicates(["doc_id", mark]).drop(mark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or parts of them, that the mix takes, a row for each time."""
    return _counted(mixed_documents(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place there."""
    pieces = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), ids=False)
    return pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
