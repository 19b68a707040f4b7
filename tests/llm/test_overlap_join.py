from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import overlap_join as J
from tests.llm.helpers import empty_documents, odd_documents

lists = st.lists(st.lists(st.integers(0, 30), max_size=12).map(lambda x: sorted(set(x))), min_size=1, max_size=14)


@given(lists, st.integers(1, 8))
@settings(max_examples=500)
def test_searches_count_occurrences(found, least):
    counts = Counter(x for one in found for x in one)
    expected = {x: n for x, n in counts.items() if n >= least}
    assert dict(J.merge_skip(found, least)) == expected
    for most in (0, J.HEAP_ENTRIES):
        J.HEAP_ENTRIES, kept = most, J.HEAP_ENTRIES
        try:
            numbers, shared = J.divide_skip([np.array(x) for x in found if x], least)
        finally:
            J.HEAP_ENTRIES = kept
        assert dict(zip(numbers.tolist(), shared.tolist())) == expected


@given(st.integers(1, 3000), st.integers(0, 200), st.integers(0, 200))
@settings(max_examples=500)
def test_bounds_hold_for_linked_sizes(shared, left, right):
    n, m = shared + left, shared + right
    if J.linked(shared, n, m):
        assert shared >= max(J.least_overlap(n), J.least_overlap(m))
        # Worst case: all that a set has of its own comes first in the order.
        first = min(J.probe_length(n) - left, J.probe_length(m) - right)
        assert first >= max(J.least_probes(n), J.least_probes(m))


def brute(rows, percent=85, words=4):
    """Per (id, text): size of the set, and smallest id of its group, by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {}
    for g, (i, _) in zip(group, rows):
        if i is not None:
            low[g] = min(low.get(g, i), i)
    return sorted(((i, len(s), low.get(g)) for (i, _), s, g in zip(rows, sets, group)), key=str)


def found_rows(docs, **how):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in J.join_similar(docs, **how).collect()), key=str)


def copies():
    """Strangers, a passage that many share, families of edited, cut and extended copies, chains, a dense
    family, the same words in another order."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(0, 4000)}"
    text = lambda n: [word() for _ in range(n)]
    passage, rows = text(60), []
    rows += [text(int(rng.integers(1, 120))) for _ in range(120)]
    rows += [text(8) + passage + text(int(rng.integers(0, 20))) for _ in range(80)]
    for _ in range(12):
        base = text(int(rng.integers(5, 200)))
        for k in range(6):
            one = list(base)
            for i in rng.integers(0, len(one), int(rng.integers(0, 4))):
                one[i] = word()
            cut = int(len(one) * rng.uniform(0, 0.2))
            rows += [one, one[cut:], one + text(cut), one + one[:cut]]
    chain = text(100)
    for _ in range(30):
        chain = chain[3:] + text(3)
        rows.append(chain)
    dense = text(70)
    for _ in range(150):
        one = list(dense)
        one[int(rng.integers(0, len(one)))] = word()
        rows.append(one)
    rows += [list(rng.permutation(dense)) for _ in range(10)] + [dense] * 5
    order = rng.permutation(len(rows))
    return [(int(i) + 10, " ".join(rows[j])) for i, j in enumerate(order)]


@pytest.mark.parametrize("small", [False, True])
def test_groups_against_all_pairs(spark, monkeypatch, small):
    if small:  # many blocks, slices and folds
        monkeypatch.setattr(J, "BLOCK_SHINGLES", 700)
        monkeypatch.setattr(J, "QUERY_ROWS", 3)
        monkeypatch.setattr(J, "FOLD_SHINGLES", 500)
    rows = copies() + [(None, None), (1, ""), (1, ""), (2, None), (None, "a b c"), (3, "A b  c"), (None, "only null ids here x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns(
        {"key": F.lit(1), "root": F.lit("x"), "n": F.lit(None), "shingles": F.lit(3), "content": F.lit("c")})
    assert found_rows(docs) == brute(rows)


def test_odd_rows_and_none(spark):
    docs = odd_documents(spark)
    assert found_rows(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert J.join_similar(empty_documents(spark)).collect() == []


def test_a_dense_group_takes_one_search_a_member(monkeypatch):
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 62, 200, dtype=np.uint64))
    sets = [np.sort(np.concatenate((np.delete(base, i % 190), rng.integers(0, 1 << 62, 1, dtype=np.uint64)))) for i in range(1500)]
    looked = Counter()
    search = J.divide_skip
    monkeypatch.setattr(J, "divide_skip", lambda lists, least: (looked.update(n=sum(map(len, lists))), search(lists, least))[1])
    assert set(J.connect(sets)) == {0}
    assert looked["n"] < 3 * sum(map(len, sets))


def test_copies_in_several_tasks_are_no_partners(spark):
    rows = [(7, [1, 2, 3]), (7, [1, 2, 3]), (8, [3, 9]), (9, [40, 50])]
    counts = J._shared_counts(spark.createDataFrame(rows, "id long, shingles array<long>").repartition(4))
    assert {r["id"]: r["shared"] for r in counts.collect()} == {7: 1, 8: 1}
