import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from footfall.llm import exact_dedup
from footfall.llm.exact_dedup import Trie, assign_owners, keep_owners
from tests.llm.helpers import ODD, empty_documents, odd_documents, rows_of


@given(st.lists(st.binary(max_size=6)))
def test_trie_counts_like_a_dictionary(keys):
    trie, counts = Trie(), {}
    for key in keys:
        trie.add(key, 1, lambda a, b: a + b)
        counts[key] = counts.get(key, 0) + 1
    assert dict(trie.items()) == counts


def brute(rows, keep):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    pick = lambda ids: (max if keep == "max" else min)([i for i in ids if i is not None], default=None)
    return {t: (pick(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items()}


@pytest.mark.parametrize("keep", ["max", "min"])
def test_assignment_against_brute_force(spark, keep, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 64)  # written out after every few texts
    expected = brute([(i, t) for i, t, *_ in ODD], keep)
    found = rows_of(assign_owners(odd_documents(spark), keep=keep))
    by_sha = {v[2]: v for v in expected.values()}
    assert len(found) == len(ODD)
    for r in found:
        assert (r["keep_id"], r["group_size"]) == by_sha[r["text_sha256"]][:2]
    assert sum(r["kept"] for r in found) == len(expected)
    assert all(r["doc_id"] == r["keep_id"] for r in found if r["kept"])


def test_kept_rows_have_all_columns(spark):
    docs = odd_documents(spark)
    kept = keep_owners(docs)
    assert kept.columns == docs.columns
    rows = rows_of(kept)
    assert len(rows) == len({t or "" for _, t, *_ in ODD})
    assert all(r["row"] == "keep me" for r in rows)
    assert [r["doc_id"] for r in rows if r["text"] == ODD[0][1]] == [2]


def test_empty(spark):
    assert assign_owners(empty_documents(spark)).count() == 0
    assert keep_owners(empty_documents(spark)).count() == 0


def test_the_bound_of_a_trie_holds_for_short_texts():
    """Nodes take most of the memory of short keys; the count follows what Python allocates."""
    import tracemalloc

    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    trie = Trie()
    for i in range(30_000):
        trie.add(hashlib.sha256(str(i).encode()).digest()[:8], (i, i, 1), exact_dedup._merge)
    taken = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert 0.6 * taken < trie.size < 2 * taken


@given(st.lists(st.binary(min_size=0, max_size=5), max_size=60), st.integers(0, 4000))
def test_spilled_subtrees_and_the_rest_are_the_whole(keys, least):
    trie = Trie()
    for key in keys:
        trie.add(key, 1, lambda a, b: a + b)
    size = trie.size
    out = list(trie.spill(least))
    rest = list(trie.items())
    assert trie.size <= max(least, 0) and trie.size == sum(exact_dedup._weight(c) for c in trie.root[1].values()) <= size
    counts = {}
    for key in keys:
        counts[key] = counts.get(key, 0) + 1
    assert sorted(out + rest) == sorted(counts.items())


def test_many_short_texts_spill_in_both_tries(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 5_000)
    rows = [(i, f"t{i % 400}") for i in range(1200)]
    found = rows_of(assign_owners(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    assert len(found) == 1200 and all(r["group_size"] == 3 and r["keep_id"] == r["doc_id"] % 400 + 800 for r in found)
