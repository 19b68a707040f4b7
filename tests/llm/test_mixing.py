import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import mixing as M
from tests.llm.helpers import ODD, empty_documents, odd_documents, rows_of


@given(st.integers(1, 500), st.integers(0, 2**64 - 1))
def test_feistel_network_is_a_permutation(size, key):
    out = M.permute(np.arange(size), np.full(size, size), np.full(size, key, np.uint64))
    assert sorted(out.tolist()) == list(range(size))


def test_permutation_of_a_large_range_and_keys_differ():
    size = (1 << 48) + 1
    index = np.concatenate((np.arange(1000), size - 1 - np.arange(1000)))
    out = M.permute(index, np.full(2000, size), np.full(2000, 5, np.uint64))
    assert len(set(out.tolist())) == 2000 and out.min() >= 0 and out.max() < size
    a, b = (M.permute(np.arange(100), np.full(100, 100), np.full(100, k, np.uint64)).tolist() for k in (1, 2))
    assert a != b and a != list(range(100))


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets by handing the excess on until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        goal = {s: most * sizes[s] if s in full else rest * weight[s] / share for s in names}
        over = {s for s in names if s not in full and goal[s] > most * sizes[s]}
        if not over:
            return goal
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 500, None: 70}, {"é": 1, "z": 1, "Z": 10**6, "": 3}, {"a": 0, "b": 5}, {"x": 7},
    {"a": 1, "b": 1000, "c": 2, "d": 3, "e": 50, "f": 4}])
def test_targets_against_brute_force(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long").withColumn("copies", F.lit(1))
    found = {r["source"]: r["target"] for r in rows_of(M.source_targets(rows))}
    expected = brute_targets(sizes)
    assert set(found) == set(expected)
    assert all(abs(found[s] - expected[s]) <= 1e-9 * max(1, expected[s]) for s in sizes)


def test_rank_is_the_whole_order(spark):
    rows = spark.range(0, 1000).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v")).repartition(7)
    got = [r["place"] for r in M.ranked(rows, [F.col("v").asc()], "place").orderBy("v").collect()]
    assert got == list(range(1000))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), " ".join(f"s{i}w{k}" for k in range(rng.integers(0, 90))), str(rng.choice(["a", "b", "c", "d"]))) for i in range(400)]
    rows += [(1000, "one long text " * 3000, None), (1001, None, "a"), (1002, " ", "e")] + [(1003, "same row here", "d")] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_shares_meet_targets_and_agree_on_reruns(corpus):
    docs, rows = corpus
    found = rows_of(M.mix_shares(docs, block_tokens=16))
    assert sorted(r["doc_id"] for r in found) == sorted(r[0] for r in rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    goal, source_of = brute_targets(sizes), {i: s for i, _, s in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source_of[r["doc_id"]]] += r["taken"]
        assert r["source_size"] == sizes[source_of[r["doc_id"]]]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in sizes)
    again = rows_of(M.mix_shares(docs.repartition(5), block_tokens=16))
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_blocks_hold_the_words_that_shares_count(corpus):
    docs, rows = corpus
    texts = {i: (t or "").split() for i, t, _ in rows}
    taken, slots = {}, {}
    for r in rows_of(M.mix_blocks(docs, block_tokens=16, shards=4)):
        words = r["text"].split()
        assert len(words) == r["n_words"] and 0 <= r["shard"] < 4
        joined = " ".join(texts[r["doc_id"]])
        assert r["text"] in joined
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(words)
        slots.setdefault((r["source"], r["slot"]), []).append((r["low"], r["n_words"]))
    shares = {}
    for r in rows_of(M.mix_shares(docs, block_tokens=16)):
        shares[r["doc_id"]] = shares.get(r["doc_id"], 0) + r["taken"]
    assert taken == {i: n for i, n in shares.items() if n}
    for parts in slots.values():  # the parts of a slot stand one behind the other
        at = 0
        for low, n in sorted(parts):
            assert low == at
            at += n
        assert at <= 16


def test_shards_are_drawn(spark, corpus):
    targets = spark.createDataFrame([("a", 100_000, 250_000.0), ("b", 100_000, 30_000.0)],
                                    "source string, source_size long, target double")
    slots = M.draw_slots(targets, 10, shards=8)
    counts = {(r["source"], r["shard"]): r["n"] for r in rows_of(slots.groupBy("source", "shard").agg(F.count("*").alias("n")))}
    assert len(counts) == 16
    for s, n in (("a", 25_000), ("b", 3_000)):
        own = np.array([counts[s, i] for i in range(8)])
        assert own.sum() == n and ((own - n / 8) ** 2 / (n / 8)).sum() < 30  # chi-squared, 7 degrees
    repeats = rows_of(slots.groupBy("source", "block").agg(F.count("*").alias("n")))
    assert {r["n"] for r in repeats if r["source"] == "a"} == {2, 3}
    assert {r["n"] for r in repeats if r["source"] == "b"} == {1}


def test_odd_and_empty_tables(spark):
    docs = odd_documents(spark).withColumn("size", F.lit("x"))
    found = rows_of(M.mix_shares(docs))
    assert len(found) == len(ODD) and all(0 <= r["taken"] <= 3 * r["size"] for r in found)
    assert sum(r["taken"] for r in found) == pytest.approx(sum(r["size"] for r in found), abs=3)
    assert M.mix_blocks(docs).agg(F.sum("n_words")).first()[0] == sum(r["taken"] for r in found)
    empty = empty_documents(spark)
    assert M.mix_shares(empty).count() == 0 and M.mix_blocks(empty).count() == 0
    assert M.mix_shares(docs.where("doc_id = 4")).count() == 1
