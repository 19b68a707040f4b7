from itertools import combinations

import numpy as np
import pytest

from footfall.llm import language_id as L
from footfall.llm.common import id_remainder, table
from tests.llm.helpers import empty_documents, odd_documents, rows_of
from tests.oracle import TESTDATA


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9, 40])
def test_codewords_differ_and_every_bit_splits(n):
    code = L.codewords(n)
    assert code.shape[0] == n
    assert all((code[i] != code[j]).any() for i, j in combinations(range(n), 2))
    if n > 1:
        assert (np.abs(code.sum(0)) < n).all()
    if n == 4:
        assert code.shape[1] == 7
        assert min((code[i] != code[j]).sum() for i, j in combinations(range(4), 2)) == 4


def test_ngrams_of_pieces_are_those_of_the_whole(monkeypatch):
    data = bytes(np.random.default_rng(1).integers(97, 123, 500, dtype=np.uint8))
    whole = np.sort(np.concatenate(list(L.places(data))))
    monkeypatch.setattr(L, "PIECE", 64)
    assert (np.sort(np.concatenate(list(L.places(data)))) == whole).all()


def test_a_wrong_bit_is_corrected():
    code = L.codewords(4)
    model = L.Model(list("abcd"), code, np.zeros((L.DIMS, 7), np.float32), np.zeros(7), np.ones(7))
    for i in range(4):
        margins = 3.0 * code[i]
        margins[i] = -margins[i]
        assert int(np.argmin(model.costs(margins))) == i


def test_held_out_accuracy(spark):
    from pyspark.sql import functions as F

    docs = table(spark, f"{TESTDATA}/sf0.01", "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    found = L.predict(docs.where(held_out), L.train(docs.where(~held_out))).join(docs, "doc_id")
    row = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert row[0] > 0.98 and row[1] > 200


def test_odd_texts(spark):
    docs = odd_documents(spark)
    found = rows_of(L.predict(docs, L.train(docs)))
    assert len(found) == docs.count()
    und = [r for r in found if r["lang_pred"] == "und"]
    assert len(und) == 4 and all(r["score"] == 0.0 and r["ambiguous"] for r in und)
    assert all(0.0 <= r["score"] <= 1.0 for r in found)


def test_nothing_to_learn_from(spark):
    model = L.train(empty_documents(spark))
    assert [r["lang_pred"] for r in rows_of(L.predict(odd_documents(spark), model))] == ["und"] * 12
    assert L.predict(empty_documents(spark), model).count() == 0
