import numpy as np
from pyspark.sql import functions as F

from tickspark.llm.language_id import Features, Ftrl, fit, fold, predict, temperature


def test_held_out_accuracy_and_calibration(spark, sf_dir):
    docs = spark.read.parquet(sf_dir.replace("sf0.001", "sf0.01") + "/documents.parquet")
    held = fold(F.col("doc_id"), 5) == 0
    out = predict(docs.where(held), fit(docs.where(~held))).toPandas()
    labelled = out[out.lang.notna() & (out.lang_pred != "und")]
    right = labelled.lang == labelled.lang_pred
    assert len(labelled) > 100 and right.mean() >= 0.97
    assert abs(labelled.score.mean() - right.mean()) < 0.05 and labelled.score.between(0, 1).all()


def test_parts_of_long_texts_have_the_same_ngrams(monkeypatch):
    from tickspark.llm import language_id as L
    text = "Grüße aus Köln, señor! " * 40
    whole = np.sort(Features().of(text))
    monkeypatch.setattr(L, "PART", 7)
    assert (np.sort(Features().of(text)) == whole).all()


def test_penalty_keeps_weights_sparse():
    state = Ftrl(np.zeros((11, 2)), np.zeros((11, 2)), l1=0.5)
    for i in range(200):
        state.learn(np.array([i % 2, 5]), np.array([1.0, 0.01]), i % 2)
    w = state.weights()
    assert w[0, 0] > 0 > w[0, 1] and not w[5].any() and not w[9].any()


def test_temperature_of_known_logits():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(4000, 3))
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(3, p=q) for q in p])
    assert 2.0 < temperature(z * 3, labels) < 4.5


def test_odd_rows(odd_docs, no_docs):
    model = fit(odd_docs)
    clash = odd_docs.withColumn("text_to_judge", F.lit(1)).withColumn("score", F.lit("x"))
    out = predict(clash, model).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert r.lang_pred in ("und", *model.languages) and 0 <= r.score <= 1
    assert fit(no_docs).languages == [] and predict(no_docs, model).count() == 0
    assert {r.lang_pred for r in predict(odd_docs, fit(no_docs)).collect()} == {"und"}
