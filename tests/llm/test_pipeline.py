"""The pipeline's stages against brute force on the smallest tables."""

import pytest

import corpus_pipeline as P
from footfall.llm.common import table, written
from tests.llm.helpers import empty_documents, odd_documents, rows_of
from tests.llm.test_simhash import brute_kept
from tests.oracle import TESTDATA

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        result = written(stage(spark, docs, SF), "test-stage")
        out.append((name, rows_of(docs), rows_of(result), docs.columns, result.columns))
        docs = result
    return out


def test_stages_keep_the_columns(steps):
    for name, _, _, before, after in steps[:-1]:
        assert before == after, name


def test_exact_copies(steps):
    _, before, after, *_ = steps[1]
    best = {}
    for r in before:
        best[r["text"]] = max(best.get(r["text"], -1), r["doc_id"])
    assert sorted(best.values()) == sorted(r["doc_id"] for r in after)


def test_near_copies(steps):
    _, before, after, *_ = steps[2]
    assert sorted(r["doc_id"] for r in after) == brute_kept([(r["doc_id"], r["text"]) for r in before])


def test_benchmark_leaks(spark, steps):
    _, before, after, *_ = steps[3]
    items = [r["text"].lower().split() for r in rows_of(table(spark, SF, "benchmark"))]

    def leaks(text):
        words = text.lower().split()
        own = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        return any(len({tuple(w[i:i + 5]) for i in range(len(w) - 4)} & own) >= 0.9 * len(w) - 4 for w in items)

    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert gone == {r["doc_id"] for r in before if leaks(r["text"])}


def test_mix_takes_all_words_that_targets_ask_for(steps):
    _, before, after, *_ = steps[4]
    total = sum(len(r["text"].split()) for r in before)
    assert sum(r["n_words"] for r in after) == pytest.approx(total, abs=20)


def test_run_is_the_stages(spark, steps):
    assert sorted(map(str, rows_of(P.run(spark, SF)))) == sorted(map(str, steps[-1][2]))


def test_odd_documents_have_defined_results(spark):
    """Nulls, empty and very long texts, ties, repeated rows, clashing columns."""
    docs, steps = odd_documents(spark), []
    for _, stage in P.STAGES:
        result = written(stage(spark, docs, SF), "test-stage")
        steps.append((rows_of(docs), rows_of(result)))
        docs = result
    pairs = lambda rows: sorted(((r["doc_id"], r["text"]) for r in rows), key=str)
    before, after = steps[0]
    assert pairs(before) == pairs(after)  # none of them is toxic
    before, after = steps[1]
    best = {}
    for r in before:
        rank = (r["doc_id"] is not None, r["doc_id"] or 0)
        best[r["text"] or ""] = max(best.get(r["text"] or "", rank), rank)
    kept = {(r["text"] or "", r["doc_id"]) for r in after}
    assert kept == {(t, i if known else None) for t, (known, i) in best.items()} and len(after) == len(best)
    for before, after in steps[2:4]:  # no two are similar, none holds a benchmark item
        assert pairs(before) == pairs(after)
    before, after = steps[4]
    assert sum(r["n_words"] for r in after) == sum(len((r["text"] or "").split()) for r in before)


def test_no_documents_give_no_rows(spark):
    docs = empty_documents(spark)
    for _, stage in P.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
        assert docs.count() == 0
