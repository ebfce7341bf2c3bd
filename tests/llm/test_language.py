import zlib

from pyspark.sql import functions as F

from tests.conftest import SF01, SF001
from txflow.llm import language
from txflow.llm.language import keep_identified, predict, train
from txflow.llm.queries import op9_language


def test_accuracy_on_rows_that_taught_nothing(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = op9_language(spark, SF01).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    apart = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"] and r["lang_pred"] != "und"]
    assert len(apart) > 100
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in apart) >= 0.97 * len(apart)


def test_label_and_source_do_not_reach_a_prediction(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = train(docs)
    told = {r["doc_id"]: tuple(r["language"]) for r in predict(docs.select("doc_id", "text"), model).collect()}
    other = docs.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit("zz")).withColumn("source", F.lit("s"))
    assert {r["doc_id"] - 7: tuple(r["language"]) for r in predict(other, model).collect()} == told


def test_odd_documents(odd_docs, no_docs, spark):
    model = train(odd_docs)
    rows = predict(odd_docs, model, out_col="told").collect()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["told"]["lang"] == "und") == (not letters) and 0 <= r["told"]["score"] <= 1
    nothing = train(no_docs)
    assert nothing.languages == [] and predict(no_docs, nothing, out_col="told").count() == 0
    assert {tuple(r["told"]) for r in predict(odd_docs, nothing, out_col="told").collect()} == {("und", 0.0)}


def test_the_stage_keeps_what_has_a_language(odd_docs, no_docs, spark):
    kept = keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == odd_docs.filter(F.col("text").rlike(r"\p{L}")).count()
    assert keep_identified(no_docs).count() == 0
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    assert keep_identified(docs).count() >= 0.99 * docs.count()


def test_a_long_text_is_read_in_parts(monkeypatch):
    text = "the quick brown fox über façade " * 500
    whole = [g.tolist() for g in language.gram_numbers(text)]
    monkeypatch.setattr(language, "AT_ONCE", 1000)
    parts = [g.tolist() for g in language.gram_numbers(text)]
    assert sorted(sum(parts, [])) == sorted(sum(whole, []))


def test_the_sample_is_bounded_when_ids_repeat(spark):
    """One id on thousands of rows, of several languages and texts: one row of each id and language."""
    rows = [(4, f"text number {i}", "en") for i in range(3000)] + [(4, "texte", "fr")] * 500
    rows += [(i, f"word {i}", "de") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "id long, text string, lang string")
    got = language._sample(docs, 40, 70).collect()
    count = {x: sum(r["lang"] == x for r in got) for x in ("en", "fr", "de")}
    assert len(got) <= 70 and count == {"en": 1, "fr": 1, "de": 40}
    assert sorted(tuple(r)[:2] for r in got) == sorted(tuple(r)[:2] for r in language._sample(docs.repartition(3), 40, 70).collect())


def test_the_regression_matches_a_plain_version():
    """FTRL-proximal, a weight at a time in Python, on random sparse rows."""
    import math

    import numpy as np

    rng = np.random.default_rng(4)
    alpha, beta, l1, l2, classes, size = 0.5, 1.0, 0.01, 0.01, 3, 12
    learner = language.Ftrl(size, classes, alpha, beta, l1, l2)
    z, n = [[0.0] * classes for _ in range(size)], [[0.0] * classes for _ in range(size)]

    def weight(i, c):
        if abs(z[i][c]) <= l1:
            return 0.0
        return (math.copysign(l1, z[i][c]) - z[i][c]) / ((beta + math.sqrt(n[i][c])) / alpha + l2)

    for _ in range(60):
        at = rng.choice(size, rng.integers(1, 6), replace=False)
        x, target = rng.uniform(0.1, 2, len(at)), int(rng.integers(classes))
        learner.learn(at, x, target)
        w = [[weight(i, c) for c in range(classes)] for i in at]
        logits = [sum(v * row[c] for v, row in zip(x, w)) for c in range(classes)]
        total = sum(math.exp(v - max(logits)) for v in logits)
        p = [math.exp(v - max(logits)) / total for v in logits]
        for i, v, row in zip(at, x, w):
            for c in range(classes):
                g = v * (p[c] - (c == target))
                z[i][c] += g - (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / alpha * row[c]
                n[i][c] += g * g
    assert np.allclose(learner.weights(), [[weight(i, c) for c in range(classes)] for i in range(size)], atol=1e-12)
    assert np.abs(learner.weights()).max() > 0.01
