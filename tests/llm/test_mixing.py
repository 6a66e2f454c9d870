import numpy as np
from pyspark.sql import functions as F

from tickspark.llm.common import words
from tickspark.llm.mixing import mixed_documents, permuted, plan_mix, shard_draws, targets


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 100, 5000):
        p = permuted(np.arange(n), n, [0, 1, 2])
        assert sorted(p) == list(range(n)) and (permuted(p, n, [0, 1, 2], back=True) == np.arange(n)).all()
    assert (permuted(np.arange(1000), 1000, [0, 1, 2]) != permuted(np.arange(1000), 1000, [0, 1, 3])).any()


def test_targets():
    assert targets([100, 100, 100], [5, 2, 1], 450, 2) == [200.0, 500 / 3, 250 / 3]
    assert targets([10, 0], [1, 5], 15, 2) == [15.0, 0.0]
    assert targets([10], [5], 45, 2) == [20.0] and targets([], [], 0, 2) == []


def test_shards_share_the_draws():
    out = shard_draws([1000, 10, 0, 500], 7, 1)
    assert out.sum(axis=0).tolist() == [1000, 10, 0, 500] and set(out.sum(axis=1)) <= {215, 216}


def test_taken_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = plan_mix(docs, keep=["doc_id", "source"]).taken().toPandas()
    text = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    assert dict(zip(rows.doc_id, rows["size"])) == text and (rows.taken <= 2 * rows["size"]).all()
    per = rows.groupby("source").agg(size=("size", "sum"), source_size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    assert (per["size"] == per.source_size).all() and abs(per.target.sum() - 1.5 * per["size"].sum()) < 1
    assert (abs(per.taken / per.target - 1) < 0.02).all()
    again = plan_mix(docs, keep=["doc_id", "source"]).taken().toPandas()
    assert rows.sort_values("doc_id").values.tolist() == again.sort_values("doc_id").values.tolist()


def test_mixed_documents_hold_the_words_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mixed = mixed_documents(docs)
    assert mixed.schema == docs.schema
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + len(words(r.text))
    taken = {r.doc_id: r.taken for r in plan_mix(docs, keep=["doc_id"]).taken().collect()}
    assert sum(count.values()) == sum(taken.values())


def test_odd_rows(odd_docs, no_docs):
    clash = odd_docs.withColumn("sid", F.lit(1)).withColumn("block_index", F.lit(2)).withColumn("cuts", F.lit("x"))
    out = plan_mix(clash, keep=["doc_id"]).taken()
    rows = out.collect()
    assert len(rows) == odd_docs.count() and all(r.taken <= 2 * r.size for r in rows)
    assert all(r.taken == 0 for r in rows if not r.size)
    assert mixed_documents(clash).columns == clash.columns
    assert mixed_documents(clash).count() > 0
    assert plan_mix(no_docs).taken().count() == 0 and mixed_documents(no_docs).count() == 0


def test_repeated_rows_are_documents_of_their_own(spark):
    text = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    rows = [(1, text(1, 600), "a", "en")] * 3 + [(2, text(2, 500), "b", "en"), (1, text(1, 600), "b", "de")] + [(None, text(3, 300), None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    taken = {}
    for r in plan_mix(docs, keep=["doc_id", "source"]).taken().collect():
        taken[r.doc_id, r.source] = taken.get((r.doc_id, r.source), 0) + r.taken
    mixed = {}
    for r in mixed_documents(docs).collect():
        mixed[r.doc_id, r.source] = mixed.get((r.doc_id, r.source), 0) + len(words(r.text))
        assert (r.lang == "de") == ((r.doc_id, r.source) == (1, "b"))
    assert {k: sum(v for j, v in taken.items() if j[1] == k) for k in ("a", "b", None)} == {
        k: sum(v for j, v in mixed.items() if j[1] == k) for k in ("a", "b", None)}
    assert mixed[1, "a"] > 1800
