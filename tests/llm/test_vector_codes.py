import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, entries=256, rounds=4):
    """Plain Python over (vec_id, vector, label)."""
    kept = [(i, [math.floor(1024 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // 4
    part = lambda v, p: v[p * width:(p + 1) * width]
    books = [[part(v, p) for _, v, _ in kept[:entries]] for p in range(4)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign(v, p):
        return min((apart(part(v, p), e), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        groups = [defaultdict(list) for _ in range(4)]
        for _, v, _ in kept:
            for p in range(4):
                groups[p][assign(v, p)[1]].append(part(v, p))
        for p in range(4):
            for e, members in groups[p].items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found, sums = [], defaultdict(int)
    for i, v, lab in kept:
        best = [assign(v, p) for p in range(4)]
        sums[lab] += sum(d for d, _ in best)
        found.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), lab))
    return sorted(((i, c, e, sums[lab], digest) for i, c, e, lab in found), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def vectors(n, seed, dims=8):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, 0.2, dims).astype(np.float32)], int(rng.integers(0, 3))) for i in range(n)]


ODD = [(None, [0.5] * 8, None), (3, None, 1), (4, [0.1] * 7 + [None], 1), (5, [float("nan")] * 8, 1),
       (6, [float("inf")] + [0.0] * 7, 2), (7, [0.25] * 8, None), (7, [0.25] * 8, None), (7, [0.125] * 8, 1)]


@pytest.mark.parametrize("salted", [False, True])
def test_against_plain_python(spark, monkeypatch, salted):
    if salted:
        monkeypatch.setattr(V, "SMALL_LABELS", 1)
        monkeypatch.setattr(V, "BLOCK_ROWS", 7)
    rows = vectors(300, 1) + ODD + vectors(40, 1)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns(
        {"code": F.lit("x"), "error": F.lit(1), "vector": F.lit(0), "part": F.lit(None), "salt": F.lit(2)})
    assert rows_of(V.compress_vectors(docs)) == brute(rows)


def test_fewer_vectors_than_entries_other_lengths_and_none(spark):
    rows = vectors(5, 2)
    others = [(90, [], 1), (91, [1.0], 1), (92, [0.5] * 4, 1)]
    found = V.compress_vectors(spark.createDataFrame(rows + others, SCHEMA))
    assert rows_of(found) == brute(rows)
    for none in ([], [(1, None, 2), (2, [], 1)]):
        empty = V.compress_vectors(spark.createDataFrame(none, SCHEMA))
        assert empty.collect() == [] and empty.columns[-1] == "codebooks_sha256"


def test_components_that_could_overflow_are_refused(spark):
    with pytest.raises(ValueError, match="beyond"):
        V.compress_vectors(spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA))
    far = [(i, [float(V.MAX_COMPONENT) * (-1) ** i] * 8, 1) for i in range(3)]
    assert rows_of(V.compress_vectors(spark.createDataFrame(far, SCHEMA), entries=2)) == brute(far, entries=2)


@given(st.integers(1, 40), st.integers(1, 9), st.sampled_from([3, 1000, 1 << 27]), st.integers(0, 99))
@settings(max_examples=60, deadline=None)
def test_tables_give_the_squared_distances(n, k, most, seed):
    rng = np.random.default_rng(seed)
    values, book = rng.integers(-most, most, (n, 5)), rng.integers(-most, most, (k, 5))
    apart = ((values[:, None, :] - book[None]) ** 2).sum(2)
    assert (V.part_distances(values, book) == apart).all()
    entry, least = V.nearest(values, book)
    assert (entry == apart.argmin(1)).all() and (least == apart.min(1)).all()


def test_rounds_bring_one_row_an_entry_to_the_driver(spark):
    rows, length = V.integer_vectors(spark.createDataFrame(vectors(500, 4), SCHEMA).repartition(8))
    books = V.fit_codebooks(rows, length, entries=16, rounds=1)
    sums = rows.select("vector").mapInArrow(V._sums(books, length), "part int, entry int, count long, sums array<long>")
    assert sums.count() <= 8 * 4 * 16
    assert sums.groupBy("part").agg(F.sum("count").alias("n")).where("n <> 500").count() == 0
