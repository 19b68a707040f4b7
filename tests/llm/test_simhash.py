import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from footfall.llm import simhash as S
from footfall.llm.components import components
from tests.llm.helpers import ODD, empty_documents, odd_documents, rows_of


@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=4))
@settings(max_examples=300)
def test_masks_cover_every_pair_within_the_radius(value, flipped):
    other = value
    for bit in flipped:
        other ^= 1 << bit
    assert any(value & m == other & m for m in S.covering_masks(4))


@given(st.sets(st.integers(0, 63), max_size=9))
@settings(max_examples=300)
def test_parts_cover_a_larger_radius(flipped):
    apart = sum(1 << bit for bit in flipped)
    assert any(apart & m == 0 for m in S.covering_masks(9, 2))


def test_masks_hold_about_half_of_the_bits():
    masks = S.covering_masks(4)
    assert len(masks) == 31 and all(28 <= m.bit_count() <= 36 for m in masks)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs):
    """Smallest id of each row's component, over rows (id, fingerprint)."""
    parent = list(range(len(pairs)))
    for i, (_, a) in enumerate(pairs):
        for j, (_, b) in enumerate(pairs[:i]):
            if (a ^ b).bit_count() <= 4:
                old, new = parent[i], parent[j]
                parent = [new if p == old else p for p in parent]
    low = {}
    for (i, _), p in zip(pairs, parent):
        if i is not None:
            low[p] = min(low.get(p, i), i)
    return [low.get(p) for p in parent]


def test_query_against_brute_force(spark):
    docs = odd_documents(spark).select("doc_id", "text", "fingerprint")
    pairs = [(i, brute_fingerprint(t)) for i, t, *_ in ODD if t is None or len(t) < 1000]
    expected = sorted(map(str, ((i, f"{f:016x}", c) for (i, f), c in zip(pairs, brute_components(pairs)))))
    found = rows_of(S.group_documents(docs.where("doc_id is null or doc_id <> 7")))
    assert sorted(str((r["doc_id"], r["fingerprint"], r["component_id"])) for r in found) == expected


@pytest.fixture(scope="module")
def dense():
    """Chains, a dense ball and strangers."""
    rng = np.random.default_rng(3)
    values = set(rng.integers(0, 2**63, 300, dtype=np.uint64).tolist())
    for start in list(values)[:20]:
        for _ in range(12):
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                start ^= 1 << int(bit)
            values.add(start)
    center = int(rng.integers(0, 2**63))
    values |= {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (300, 2))}
    return sorted(values)


@pytest.mark.parametrize("most", [50_000, 40])
def test_links_connect_what_is_within_the_radius(spark, dense, most):
    signed = [(S._signed(v),) for v in dense]
    links = S.links_within(spark.createDataFrame(signed, "fingerprint long"), 4, most=most)
    found = {r["node"]: r["root"] for r in rows_of(components(links))}
    expected = brute_components([(s, v) for (s,), v in zip(signed, dense)])
    assert [found.get(s, s) for (s,) in signed] == expected


def test_runs_of_sorted_batches():
    import pyarrow as pa

    keys = np.sort(np.random.default_rng(0).integers(0, 30, 500))
    keys = np.concatenate((keys, np.full(100, 40), [41]))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + 17]), pa.array(np.arange(len(keys))[i:i + 17])], ["k", "v"])
               for i in range(0, len(keys), 17)]
    whole, pieces = {}, []
    for (k, v), bounds, large in S._runs(iter(batches), 50):
        for a, b in zip(bounds[:-1], bounds[1:]):
            assert len(set(k[a:b])) == 1
            if large:
                pieces += v[a:b].tolist()
            else:
                assert k[a] not in whole
                whole[k[a]] = v[a:b].tolist()
    large = {k for k in set(keys) if (keys == k).sum() > 50}
    assert sorted(pieces) == np.flatnonzero(np.isin(keys, list(large))).tolist()
    assert {k: v for k, v in whole.items()} == {k: np.flatnonzero(keys == k).tolist() for k in set(keys) - large}


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    links = spark.createDataFrame(path + star + [(7, 7), (3, 2)], "a long, b long")
    found = {r["node"]: r["root"] for r in rows_of(components(links))}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}


def similar_texts():
    rng = np.random.default_rng(11)
    vocabulary = np.array([f"word{i}" for i in range(3000)])
    rows = []
    for group in range(12):
        base = rng.choice(vocabulary, int(rng.integers(60, 400)))
        rows.append(" ".join(base))
        for _ in range(4):
            copy = base.copy()
            for at in rng.choice(len(base), max(1, int(len(base) * rng.uniform(0.002, 0.03))), replace=False):
                copy[at] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    return list(enumerate(rows)) + [(900, "a b"), (901, "a b"), (902, None), (903, ""), (904, "c d")]


def brute_kept(rows, exact=0.8):
    sets = [(i, t, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else None)
            for i, t in rows]
    parent = list(range(len(rows)))
    for i, (_, t, a) in enumerate(sets):
        for j, (_, u, b) in enumerate(sets[:i]):
            same = (t or "") == (u or "") or (a and b and len(a & b) / len(a | b) >= exact)
            if same:
                old, new = parent[i], parent[j]
                parent = [new if p == old else p for p in parent]
    return sorted(min(rows[i][0] for i in range(len(rows)) if parent[i] == p) for p in set(parent))


@pytest.mark.parametrize("most", [50_000, 3])
def test_similar_texts_against_brute_force(spark, most, monkeypatch):
    if most < 100:
        monkeypatch.setattr(S, "ALL_PAIRS", 2)
        monkeypatch.setattr(S, "NEAREST", 1)
        monkeypatch.setattr(S, "BLOCK_ROWS", 2)
    rows = similar_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = rows_of(S.drop_similar(docs, most=50_000 if most > 100 else 6))
    assert sorted(r["doc_id"] for r in kept) == brute_kept(rows)


def test_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    kept = S.drop_similar(docs)
    assert kept.columns == docs.columns
    rows = rows_of(kept)
    assert len(rows) == len({t or "" for _, t, *_ in ODD})
    assert [r["doc_id"] for r in rows if r["text"] == ODD[0][1]] == [1]
    empty = empty_documents(spark)
    assert S.drop_similar(empty).count() == 0 and S.group_documents(empty).count() == 0


def cut_and_extended_texts(groups=60):
    rng = np.random.default_rng(23)
    vocabulary = np.array([f"word{i}" for i in range(3000)])
    rows = []
    for at in range(groups):
        base, block = (list(rng.choice(vocabulary, int(rng.integers(60, 400)))) for _ in range(2))
        share = 0.1 + 0.08 * at / groups
        rows += [" ".join(base), " ".join(base[:int(len(base) * (1 - share))]),
                 " ".join(base + block[:int(len(base) * share)])]
    return list(enumerate(rows))


def test_cut_and_extended_copies_against_brute_force(spark):
    rows = cut_and_extended_texts()
    kept = rows_of(S.drop_similar(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted(r["doc_id"] for r in kept) == brute_kept(rows)


def test_bands_miss_no_pair_of_the_similarity():
    rng = np.random.default_rng(5)
    for _ in range(300):
        shared, left, right = (rng.integers(0, 256, (n, 8), dtype=np.uint8) for n in (160, 20, 20))
        a, b = (S.min_hashes(np.concatenate((shared, own))) for own in (left, right))  # similar to 0.8
        assert (S.band_keys(a) == S.band_keys(b)).any()
        apart = (S.min_bits(a) ^ S.min_bits(b)).view(np.uint64)
        assert np.bitwise_count(apart).sum() <= S.most_mismatches(0.8)


def repeated_lines():
    rng = np.random.default_rng(29)
    vocabulary = np.array([f"word{i}" for i in range(3000)])
    rows = []
    for _ in range(6):
        base = " ".join(rng.choice(vocabulary, 200))
        rows += [base, f"{base} {base}", base + f" {base[-80:]}" * 40]
    return list(enumerate(rows))


def test_repeated_lines_against_brute_force(spark):
    rows = repeated_lines()
    kept = rows_of(S.drop_similar(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted(r["doc_id"] for r in kept) == brute_kept(rows) == list(range(0, 18, 3))


def test_hot_bucket_of_reshuffled_words_takes_linear_work(monkeypatch):
    rng = np.random.default_rng(31)
    n, sizes, whole = 5_000, [], S.propose
    monkeypatch.setattr(S, "propose", lambda fp, *how: sizes.append(len(fp)) or whole(fp, *how))
    sketch = [rng.integers(-2**63, 2**63, n) for _ in S.SKETCH]  # same words in another order: no shingle shared
    sketch = [np.concatenate((c, c[:100])) for c in sketch]  # and a few equal ones
    one = np.ones(n + 100, np.int64)
    columns = [one, 0 * one, 7 * one, np.arange(n + 100), 90 * one, *sketch]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[i:i + 700]) for c in columns],
                                          ["bucket", "mask", "fingerprint", "content", "n_shingles", *S.SKETCH])
               for i in range(0, n + 100, 700)]
    out = list(S._bucket_pairs(9, S.covering_masks(9, 2), 0.8, 1_000, 4)(iter(batches)))
    assert out is not None and sum(sizes) == n + 100 and max(sizes) <= S.SLICE_ROWS
    bands = pa.Table.from_batches(S._band_pairs(0.8, 1_000)(
        pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(3), *b.columns[5:]],
                                   ["bucket", "content", "root", *S.SKETCH]) for b in batches)).to_pydict()
    named = {a for kind, a in zip(bands["kind"], bands["a"]) if kind == 1}
    assert named == set(range(n + 100)) and {b for k, b in zip(bands["kind"], bands["b"]) if k == 1} == {0}


def test_texts_that_share_a_hash_are_told_apart(spark, monkeypatch):
    """With a hash of three values every text collides; none may be taken for another."""
    monkeypatch.setattr(S, "_content", lambda text: S.F.pmod(S.F.xxhash64(S.F.coalesce(text, S.F.lit(""))), S.F.lit(3)))
    texts = [" ".join(f"w{i * 50 + j}" for j in range(30)) for i in range(8)]
    rows = [(i, texts[i % 8]) for i in range(16)] + [(20, None), (21, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    numbers = docs.select(S.told_apart(docs).alias("n"), "text").distinct().collect()
    assert len({r.n for r in numbers if r.text}) == 8
    assert sorted(r["doc_id"] for r in rows_of(S.drop_similar(docs))) == [*range(8), 20]
