from pyspark.sql import functions as F

import corpus_pipeline as P
from tickspark.llm.common import stored, words


def test_stages_keep_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    counts = []
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        counts.append(docs.count())
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.where(F.length("text") != F.col("n_chars")).count() == 0
    assert counts[0] == 200 and counts[2] <= counts[1] <= counts[0]
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs_schema):
    text = " ".join(f"word{i}" for i in range(100))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text + " more", "en", "a", 1), (2, "else entirely", "en", "b", 1),
            (None, text, None, None, None), (3, None, "en", "a", None), (4, "", "en", "a", 0)]
    left = P.drop_near_duplicates(spark, spark.createDataFrame(rows, docs_schema), "")
    kept = left.collect()
    assert sum(len(words(r.text)) >= 100 for r in kept) == 1 and len(kept) == 4


def test_odd_rows_pass_all_stages(spark, odd_docs, no_docs):
    for given in (odd_docs, no_docs):
        docs = given.withColumn("n_lines", F.lit(1)).withColumn("lang_pred", F.lit("x")).withColumn("text_hash", F.lit(2))
        for name, stage in P.STAGES:
            docs = stored(stage(spark, docs, ""), name)
        assert (docs.count() > 0) == (given is odd_docs)
