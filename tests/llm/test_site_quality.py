import numpy as np
from pyspark.sql import functions as F

from footfall.llm import site_quality as Q
from footfall.llm.common import id_remainder, table
from tests.llm.helpers import empty_documents, odd_documents, rows_of
from tests.oracle import TESTDATA


def test_held_out_accuracy(spark):
    docs, labels = table(spark, f"{TESTDATA}/sf0.01", "documents"), table(spark, f"{TESTDATA}/sf0.01", "labels")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    scored = Q.score_quality(docs, labels.where(~held_out)).join(labels.where(held_out), "doc_id")
    row = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert row[0] > 0.95 and row[1] > 50


def test_regression_against_gradient():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    y = (x @ [1.0, -2.0, 0.5] + 0.3 + rng.logistic(size=400) > 0).astype(float)
    weights, bias = Q.fit_regression(x, y)
    p = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert abs((y - p).sum()) < 1e-3  # the intercept is not penalised
    z = (x - x.mean(0)) / x.std(0)
    assert np.allclose(z.T @ (y - p), weights * x.std(0), atol=1e-5)


def test_sparse_sites_shrink_and_full_ones_do_not(spark):
    rows = [("bad", "x", 0, 0.5)] * 300 + [("good", "x", 1, 0.5)] * 300 + [("good", "y", 1, 0.5)] * 300 + [
        ("rare", "x", 0, 0.5)] + [(None, None, None, 0.9)] * 5
    found = {(r["host"], r["path"]): r for r in rows_of(Q.site_posteriors(
        spark.createDataFrame(rows, "host string, path string, good int, p double")))}
    overall = found["bad", "x"]["global_rate"]
    assert 0.6 < overall < 0.7 and set(found) == {("bad", "x"), ("good", "x"), ("good", "y"), ("rare", "x"), (None, None)}
    assert found["bad", "x"]["path_rate"] < 0.05 and found["good", "y"]["path_rate"] > 0.95
    assert 0.05 < found["rare", "x"]["host_rate"] < overall
    assert overall < found[None, None]["host_rate"] < 0.9


def test_scores_combine_text_and_site(spark):
    docs, labels = odd_documents(spark), spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (6, 1), (8, 0)], "doc_id long, quality int")
    found = rows_of(Q.score_quality(docs, labels))
    assert len(found) == docs.count()
    for r in found:
        assert 0.0 <= r["score"] <= 1.0 and r["predicted"] == int(r["score"] >= 0.5)


def test_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    found = rows_of(Q.score_quality(odd_documents(spark), none))
    assert len(found) == 12 and all(abs(r["score"] - 0.5) < 1e-9 for r in found)
    assert Q.score_quality(empty_documents(spark), none).count() == 0
