"""SimHash near-duplicates by covering locality-sensitive hashing.

**Fingerprints.** A document's word shingles, repeats included, are hashed to 64 bits;
a bit of the fingerprint is 1 if it is set in more than half of the hashes.

**Covering.** For a radius r every bit position gets a vector of r + 1 bits. Each of the
2^(r+1) - 1 non-zero vectors v gives a mask of the positions whose vector has an odd
product with v. At most r differing positions leave some v orthogonal to all of them, so
a pair within the radius agrees on all bits of that mask: it always collides in some
table. A mask holds about half of the bits, so unrelated fingerprints rarely collide.
``parts`` splits the bits first; by the pigeonhole one part has at most r / parts
differing bits, which needs far fewer masks for a large radius.

**Buckets.** Rows (bucket, fingerprint) are sorted within partitions, and a task walks
through one bucket after the other. Within a bucket a search over the unvisited members
links only what is needed for connectivity, so a dense bucket gives a link per member,
not all pairs. In ``group_documents`` a bucket above ``BUCKET_ROWS`` is not held: its rows go
on to a second covering of other masks, which splits it and loses no pair either.

**Components** are found by joins (see ``components``).

``similar_groups`` is for texts that are similar rather than nearly equal: word shingles
with a Jaccard similarity of 0.8 or more. A small fingerprint distance of the *word sets*
proposes pairs cheaply, but misses copies with a block cut off or added. Bands of MinHashes
of the shingles therefore propose all pairs that are not yet in one group, and an exact
comparison of the shingle sets decides.

Null and empty texts have no shingles and fingerprint zero; they are linked like any
other. A null id is never the smallest unless all ids of a group are null. Rows may
repeat, and other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import packed, thinned, written
from footfall.llm.components import components
from footfall.session import carry_to_workers

carry_to_workers(__name__)

BITS = 64
SEED = 42
BUCKET_ROWS = 50_000  # of one bucket that a task holds
_CHUNK = 1 << 16


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words joined by spaces, as rows of 8 bytes."""
    if not words:
        return np.empty((0, 8), np.uint8)
    line, size = b" ".join(words), min(size, len(words))
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_digest
    joined = b"".join([digest(line[a:b - 1], SEED) for a, b in zip(starts, starts[size:])])
    return np.frombuffer(joined, np.uint8).reshape(-1, 8)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint, as a signed 64-bit number."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        ones += np.unpackbits(hashes[i:i + _CHUNK], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def _fold(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (a signed 64-bit number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority(shingle_hashes(_fold(t.as_py()), words)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fingerprint"])

    return docs.select(docs[doc_id].cast("long"), docs[text]).mapInArrow(run, "doc_id long, fingerprint long")


def covering_masks(radius: int, parts: int = 1, seed: int = 1) -> list[int]:
    """Masks such that any two 64-bit numbers within ``radius`` agree under at least one."""
    if not 0 < parts <= BITS:
        raise ValueError("parts must be between 1 and 64")
    places = np.random.default_rng(seed).permutation(BITS)
    masks = []
    for part in range(parts):
        own, dims = places[part::parts], radius // parts + 1
        # Vectors are dealt evenly, so that masks are of like size.
        vectors = {int(bit): 1 + i % ((1 << dims) - 1) for i, bit in enumerate(own)}
        for v in range(1, 1 << dims):
            masks.append(sum(1 << bit for bit, m in vectors.items() if (m & v).bit_count() & 1))
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def bucketed(rows: DataFrame, fingerprint: Column, masks: list[int], above: Column | None = None) -> DataFrame:
    """``rows`` once for each mask, with the mask's number and a hash of the masked bits."""
    keep = [F.lit(_signed(m)).cast("long") for m in masks]
    tables = F.posexplode(F.transform(F.array(*keep), lambda m: fingerprint.bitwiseAND(m)))
    out = rows.select("*", tables.alias("mask", "masked"))
    return out.withColumn("bucket", F.xxhash64("mask", "masked", *([above] if above is not None else []))).drop("masked")


def _runs(batches: Iterator[pa.RecordBatch], most: int):
    """Runs of equal first column over sorted batches: (columns, bounds) where run i is
    ``bounds[i]:bounds[i + 1]``; of a run above ``most`` rows only pieces, marked by a
    true third value."""
    held: list[np.ndarray] | None = None
    spilling = None  # key of the run that is being passed on
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(pair) for pair in zip(held, columns)]
        if not len(columns[0]):
            continue
        key = columns[0]
        if spilling is not None:
            stop = int(np.searchsorted(key != spilling, True)) if key[-1] != spilling else len(key)
            if stop:
                yield [c[:stop] for c in columns], np.array([0, stop]), True
            columns = [c[stop:] for c in columns]
            key = columns[0]
            if not len(key):
                held = None
                continue
            spilling = None
        bounds = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        last = int(bounds[-1])
        if last:
            yield from _sized([c[:last] for c in columns], bounds, most)
        held = [c[last:] for c in columns]
        if len(held[0]) > most:
            spilling = held[0][0]
            yield held, np.array([0, len(held[0])]), True
            held = None
    if held is not None:
        yield from _sized(held, np.array([0, len(held[0])]), most)


def _sized(columns: list[np.ndarray], bounds: np.ndarray, most: int):
    if bounds[-1] != len(columns[0]):
        bounds = np.append(bounds, len(columns[0]))
    large = np.flatnonzero(np.diff(bounds) > most)
    for i in large:
        yield [c[bounds[i]:bounds[i + 1]] for c in columns], np.array([0, bounds[i + 1] - bounds[i]]), True
    if len(large) < len(bounds) - 1:
        keep = np.repeat(np.diff(bounds) <= most, np.diff(bounds))
        sizes = np.diff(bounds)
        sizes = sizes[sizes <= most]
        yield [c[keep] for c in columns], np.concatenate(([0], np.cumsum(sizes))), False


def connect(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (smallest member, member) of the parts of ``values`` connected within ``radius``."""
    links, rest = [], np.sort(values)
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        todo = [root]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= radius
            if near.any():
                found = rest[near]
                links += [(int(root), int(x)) for x in found]
                todo += list(found)
                rest = rest[~near]
    return links


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("again", pa.bool_())])


def _bucket_links(radius: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, fp), bounds, large in _runs(batches, most):
            if large:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), pa.array(fp), pa.array(np.ones(len(fp), bool))], schema=_LINK)
                continue
            fp, sizes, links = fp.view(np.uint64), np.diff(bounds), []
            pair = bounds[:-1][sizes == 2]
            near = pair[np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= radius]
            for start, stop in zip(bounds[:-1][sizes > 2], bounds[1:][sizes > 2]):
                links += connect(fp[start:stop], radius)
            a = np.concatenate((fp[near], np.array([x[0] for x in links], np.uint64)))
            b = np.concatenate((fp[near + 1], np.array([x[1] for x in links], np.uint64)))
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.zeros(len(a), bool))],
                    schema=_LINK)
    return run


def links_within(distinct: DataFrame, radius: int, parts: int = 1, most: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a, b`` that connect all ``fingerprint`` values within ``radius`` of each other
    (directly or along other links within the radius). Values must be distinct."""
    rows = bucketed(distinct.select("fingerprint"), F.col("fingerprint"), covering_masks(radius, parts))
    found, level = None, 1
    while True:
        sorted_rows = rows.select("bucket", "fingerprint").repartition("bucket").sortWithinPartitions("bucket")
        out = written(sorted_rows.mapInArrow(
            _bucket_links(radius, most if level < 4 else 1 << 62), "a long, b long, again boolean"), "bucket-links")
        links = out.where("NOT again").select("a", "b")
        found = links if found is None else found.unionByName(links)
        again = out.where("again")
        if level == 4 or again.isEmpty():
            return found
        level += 1
        rows = bucketed(again.select(F.col("a").alias("above"), F.col("b").alias("fingerprint")),
                        F.col("fingerprint"), covering_masks(radius, parts, seed=level), F.col("above"))


def group_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4,
                    radius: int = 4, parts: int = 1) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the
    smallest id that can be reached over links of at most ``radius`` differing bits."""
    rows = written(fingerprints(docs, doc_id, text, words), "fingerprints")
    distinct = written(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("low")), "distinct")
    labels = written(components(links_within(distinct, radius, parts)), "labels")
    named = labels.join(distinct, labels["node"] == distinct["fingerprint"])
    lowest = named.groupBy("root").agg(F.min("low").alias("lowest"))
    reached = labels.join(lowest, "root").select(F.col("node").alias("fingerprint"), "lowest")
    final = written(distinct.join(reached, "fingerprint", "left").select(
        "fingerprint", F.coalesce("lowest", "low").alias("component_id")), "reached")
    return rows.join(final, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


# ------------------------------------------------------------ similar texts

SIMILARITY = 0.8
SHINGLE_WORDS = 5
WORD_RADIUS, WORD_PARTS = 9, 2  # bits between the word-set fingerprints of a proposed pair
MIN_BITS = 256                  # bits of a second sketch of the shingles, one MinHash each
BANDS, BAND_ROWS = 32, 4        # a pair of similarity s meets in no band with (1 - s^4)^32: 5e-8 at 0.8
ALL_PAIRS = 64                  # members of a bucket up to which every pair is proposed
NEAREST = 4                     # beyond: the nearest of each member, in slices of the bucket
SLICE_ROWS = 256                # members of such a slice
BLOCK_ROWS = 1_000              # texts of a dense cluster that are compared with as many others


def word_set_fingerprint(words: list[bytes]) -> int:
    """The fingerprint of the distinct words. Where scattered words are edited, shingles similar
    to 0.8 go with word sets similar to about 0.95, so fingerprints differ in few bits. Where a
    block is cut off or added they need not."""
    found = [xxhash.xxh64_digest(w, SEED) for w in sorted(set(words))]
    return majority(np.frombuffer(b"".join(found), np.uint8).reshape(-1, 8))


_rng = np.random.default_rng(17)
_FACTORS = _rng.integers(0, 1 << 31, MIN_BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _rng.integers(0, 1 << 32, MIN_BITS, dtype=np.uint32)
SKETCH = ["s0", "s1", "s2", "s3"]


_MIX = _rng.integers(0, 1 << 62, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """``MIN_BITS`` MinHashes; those of two texts are equal with a probability of their similarity."""
    codes = np.ascontiguousarray(hashes).view(np.uint32).reshape(-1, 2)[:, 0]
    least = np.full(MIN_BITS, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(codes), 1024):
        least = np.minimum(least, (_FACTORS[:, None] * codes[None, i:i + 1024] + _SHIFTS[:, None]).min(1))
    return least


def min_bits(least: np.ndarray) -> np.ndarray:
    """One bit of each MinHash, as four numbers. Bits of two texts differ with a probability
    of (1 - similarity) / 2."""
    return np.packbits(least * np.uint32(0x9E3779B1) >> np.uint32(31)).view(np.int64)


def band_keys(least: np.ndarray) -> np.ndarray:
    """A number for each band of ``BAND_ROWS`` MinHashes."""
    rows = least[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
    return (rows * _MIX).sum(1, dtype=np.uint64).view(np.int64)


def most_mismatches(similarity: float) -> int:
    """Bits in which texts of ``similarity`` differ, and 6 standard deviations more."""
    p = (1 - similarity) / 2
    return int(np.ceil(MIN_BITS * p + 6 * np.sqrt(MIN_BITS * p * (1 - p))))


def _sketches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [_fold(t.as_py()) for t in batch.column(1)]
            shingles = [np.unique(shingle_hashes(w, words).reshape(-1).view(np.int64)) for w in lists]
            least = [min_hashes(x) for x in shingles]
            sketch = np.array([min_bits(m) for m in least], np.int64).reshape(-1, len(SKETCH))
            bands = np.array([band_keys(m) for m in least], np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([word_set_fingerprint(w) for w in lists], pa.int64()),
                 pa.array([len(x) for x in shingles], pa.int64()),
                 *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(len(SKETCH))),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(lists) + 1, dtype=np.int32) * BANDS), pa.array(bands))],
                ["content", "fingerprint", "n_shingles", *SKETCH, "bands"])
    return run


def _shingle_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingle_hashes(_fold(t.as_py()), size).reshape(-1).view(np.int64))
                     for t in batch.column(1)]
            lengths = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            values = pa.array(np.concatenate(found) if found else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(lengths), values)], ["content", "shingles"])
    return run


def propose(fp: np.ndarray, sketch: np.ndarray, radius: int, mismatches: int,
            nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions within ``radius`` whose sketches agree but for ``mismatches`` bits.

    A small bucket gives all of them, a large one those of each member with its
    ``nearest`` others; so a dense group takes few pairs a member, not all."""
    row, column = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius)
    pick = row < column if len(fp) <= ALL_PAIRS else row != column
    row, column = row[pick], column[pick]
    apart = np.bitwise_count(sketch[row] ^ sketch[column]).sum(1, dtype=np.int64)
    row, column, apart = row[apart <= mismatches], column[apart <= mismatches], apart[apart <= mismatches]
    if len(fp) > ALL_PAIRS:
        order = np.lexsort((apart, row))
        row, column = row[order], column[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)  # among the pairs of its row
        row, column = row[place < nearest], column[place < nearest]
    return row, column


def _slices(content: np.ndarray, bucket: int, start: int, stop: int, most: int) -> Iterator[np.ndarray]:
    """Positions of a run in slices of ``most``, which differ from bucket to bucket, so that
    groups grow together over the tables."""
    order = np.arange(start, stop)
    if stop - start > most:
        order = order[np.argsort(content[start:stop] ^ bucket)]
    for i in range(0, len(order), most):
        yield order[i:i + most]


_NODE = ["fingerprint", "content", "n_shingles", *SKETCH]


def _bucket_pairs(radius: int, masks: list[int], similarity: float, most: int, nearest: int):
    """Proposed pairs ``a, b``. A bucket above ``SLICE_ROWS`` is taken in slices, so that work
    grows with its rows; what meets in no slice is left to the bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.array(masks, np.uint64)
        mismatches = most_mismatches(similarity)
        for (bucket, mask, *node), bounds, _ in _runs(batches, most):
            fp, content, n = node[0].view(np.uint64), *node[1:3]
            sketch = np.column_stack(node[3:]).view(np.uint64)
            found = []
            many = np.diff(bounds) > 1
            for start, stop in zip(bounds[:-1][many], bounds[1:][many]):
                for at in _slices(content, bucket[start], start, stop, SLICE_ROWS):
                    a, b = propose(fp[at], sketch[at], radius, mismatches, nearest)
                    # A pair is proposed by the first table in which it meets, and once.
                    a, b = np.divmod(np.unique(np.minimum(a, b) * len(at) + np.maximum(a, b)), len(at))
                    a, b = at[a], at[b]
                    first = (((fp[a] ^ fp[b])[:, None] & tables[None, :mask[start]]) != 0).all(1)
                    a, b = a[first], b[first]
                    alike = np.minimum(n[a], n[b]) >= (similarity - 1e-9) * np.maximum(n[a], n[b])
                    found.append((content[a[alike]], content[b[alike]]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
    return run


def _propose_pairs(rows: DataFrame, radius: int, parts: int, similarity: float, most: int) -> DataFrame:
    """Proposed pairs ``a, b`` of contents whose fingerprints are within the radius."""
    masks = covering_masks(radius, parts)
    dealt = bucketed(rows, F.col("fingerprint"), masks).select("bucket", "mask", *_NODE)
    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _bucket_pairs(radius, masks, similarity, most, NEAREST), "a long, b long").where("a <> b").distinct()


def _in_several_groups(most: int):
    """Rows (bucket, content) of the buckets whose members are not all in one group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket, content, root), bounds, large in _runs(batches, most):
            size, start = np.diff(bounds), bounds[:-1]
            apart = np.minimum.reduceat(root, start) != np.maximum.reduceat(root, start)
            keep = np.repeat(apart | large, size)  # of a large bucket a piece may be in one group
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(bucket[keep]), pa.array(content[keep])], ["bucket", "content"])
    return run


_PROPOSED, _MORE = 0, 1
_BAND_PAIR = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _band_pairs(similarity: float, most: int):
    """Rows of two kinds: proposed pairs between groups, of a bucket above ``ALL_PAIRS`` each
    member with its nearest only; and members ``a`` of left-out pairs with one, ``b``, that
    stands for their bucket. A bucket above ``BLOCK_ROWS`` is taken in slices, and all its
    members are given as such, so that work grows with its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mismatches = most_mismatches(similarity)
        stands = None  # (bucket, member) of the bucket that comes in pieces

        def emit(kind, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], schema=_BAND_PAIR)

        for (bucket, content, root, *sketch), bounds, large in _runs(batches, most):
            sketch = np.column_stack(sketch).view(np.uint64)
            left, right = [], []
            for start, stop in zip(bounds[:-1], bounds[1:]):
                sliced = large or stop - start > BLOCK_ROWS
                if sliced:
                    if stands is None or stands[0] != bucket[start]:
                        stands = bucket[start], content[start]
                    yield emit(_MORE, content[start:stop], np.full(stop - start, stands[1]))
                for own in _slices(content, bucket[start], start, stop, BLOCK_ROWS):
                    apart = np.bitwise_count(sketch[own, None] ^ sketch[None, own]).sum(2, dtype=np.int64)
                    apart[root[own, None] == root[None, own]] = MIN_BITS + 1
                    met = apart <= mismatches
                    if sliced or len(own) > ALL_PAIRS:
                        a, b = np.arange(len(own)), apart.argmin(1)
                        a, b = a[met[a, b]], b[met[a, b]]
                        out = content[own[met.sum(1) > 1]]
                        if len(out) and not sliced:
                            yield emit(_MORE, out, np.full(len(out), out[0]))
                    else:
                        a, b = np.nonzero(np.triu(met, 1))
                    left.append(content[own[a]])
                    right.append(content[own[b]])
            if left:
                a, b = np.concatenate(left), np.concatenate(right)
                yield emit(_PROPOSED, np.minimum(a, b), np.maximum(a, b))
    return run


def _propose_by_bands(sketches: DataFrame, groups: DataFrame, similarity: float, most: int) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` that share a band and are not in one group yet, and links ``a, b`` between
    the members of dense bands."""
    rooted = sketches.join(groups.withColumnRenamed("node", "content"), "content", "left").withColumn(
        "root", F.coalesce("root", "content"))
    rooted = written(rooted.select("content", "root", *SKETCH, "bands"), "rooted")
    keys = rooted.select("content", "root", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), "content", "root")
    shared = keys.repartition("bucket").sortWithinPartitions("bucket", "content").mapInArrow(
        _in_several_groups(most), "bucket long, content long")
    rows = written(shared, "shared-bands").join(rooted.drop("bands"), "content").select("bucket", "content", "root", *SKETCH)
    out = written(rows.repartition("bucket").sortWithinPartitions("bucket", "content").mapInArrow(
        _band_pairs(similarity, most), "kind int, a long, b long"), "band-pairs")
    pairs, more = (out.where(F.col("kind") == k).select("a", "b").distinct() for k in (_PROPOSED, _MORE))
    return pairs, more


def _sets_of(wanted: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """``content, shingles`` (sorted hashes of the distinct shingles) of the wanted contents."""
    met = texts.join(wanted.hint("merge"), "content", "left_semi")
    return met.mapInArrow(_shingle_sets(words), "content long, shingles array<long>").dropDuplicates(["content"])


def _verified(pairs: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs whose shingle sets are similar, by comparing the sets."""
    wanted = pairs.select(F.col("a").alias("content")).union(pairs.select("b")).distinct()
    sets = written(_sets_of(wanted, texts, words), "shingles")
    left = sets.withColumnsRenamed({"content": "a", "shingles": "sa"})
    right = sets.withColumnsRenamed({"content": "b", "shingles": "sb"})
    shared = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", (shared / (F.size("sa") + F.size("sb") - shared)).alias("similarity"))
    return both.where(F.col("similarity") >= similarity)


def _compare_blocks(similarity: float):
    """Links between the texts of two blocks that are not yet in one group, by exact comparison."""
    def run(table: pa.Table) -> pa.Table:
        mismatches = most_mismatches(similarity)
        column = {c: table.column(c).to_numpy() for c in table.column_names if c != "shingles"}
        sets = [s.values.to_numpy() for s in table.column("shingles").combine_chunks()]
        content = column["content"]
        sketch = np.column_stack([column[c] for c in SKETCH]).view(np.uint64)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        roots = column["root"].tolist()
        links: list[tuple[int, int]] = []
        two = len(set(column["block"].tolist())) > 1
        for i in range(len(content)):
            apart = np.bitwise_count(sketch[i + 1:] ^ sketch[i]).sum(1, dtype=np.int64)
            if two:
                apart[column["block"][i + 1:] == column["block"][i]] = MIN_BITS + 1
            for j in (np.argsort(apart)[:int((apart <= mismatches).sum())] + i + 1).tolist():
                a, b = find(roots[i]), find(roots[j])
                if a == b:
                    continue
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if shared >= similarity * (len(sets[i]) + len(sets[j]) - shared):
                    parent[a] = b
                    links.append((int(content[i]), int(content[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([x for _, x in links], pa.int64())})
    return run


def _dense_links(dense: DataFrame, sketches: DataFrame, groups: DataFrame, texts: DataFrame, words: int,
                 similarity: float) -> DataFrame:
    """What is left out in dense buckets, between texts that are not in one group. The members
    of a cluster are cut into blocks, and two blocks meet in a task of their own; blocks of the
    cluster's largest group meet only those of the rest. Pairs never leave a task, only links do."""
    named = components(dense)
    alone = dense.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    clusters = named.unionByName(alone.join(named, "node", "left_anti")).select(
        F.col("node").alias("content"), F.col("root").alias("cluster")).distinct()
    clusters = written(clusters.join(groups.withColumnRenamed("node", "content"), "content", "left").withColumn(
        "root", F.coalesce("root", "content")), "clusters")
    size = clusters.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("cluster").agg(
        F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n")).where("main.n < n")
    blocks = lambda n: F.ceil(n / BLOCK_ROWS).cast("long")
    size = size.select("cluster", F.col("main.root").alias("main"), blocks(F.col("n") - F.col("main.n")).alias("rest"),
                       blocks(F.col("main.n")).alias("settled"))
    place, main = F.xxhash64("content"), F.col("root") == F.col("main")
    members = written(clusters.join(size, "cluster").select(
        "content", "cluster", "root",
        F.when(main, F.col("rest") + F.pmod(place, "settled")).otherwise(F.pmod(place, "rest")).alias("block"),
        (F.col("rest") + F.when(main, 0).otherwise(F.col("settled"))).alias("others")), "members")
    rows = members.join(sketches.select("content", *SKETCH), "content").join(
        _sets_of(members.select("content").distinct(), texts, words), "content")
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))).select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "content", "root", *SKETCH, "shingles")
    return dealt.groupBy("cluster", "low", "high").applyInArrow(_compare_blocks(similarity), "a long, b long")


def similar_groups(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                   radius: int = WORD_RADIUS, parts: int = WORD_PARTS, most: int = BUCKET_ROWS,
                   own: Column | None = None) -> DataFrame:
    """``node, root`` for contents (hashes of texts) that are similar to another one: two texts
    are linked if their word shingles have a Jaccard similarity of ``similarity`` or more.

    Pairs within the fingerprint radius are proposed if a second sketch does not speak against
    them, and decided by exact comparison. Pairs of different groups that share a band of
    MinHashes follow in the same way, whatever their fingerprints. Dense buckets propose a few
    pairs a member; what dense bands leave out between texts that are not in one group by then
    is compared by blocks."""
    texts = docs.select((own if own is not None else told_apart(docs, text)).alias("content"), docs[text].alias("text"))
    kinds = ["content", "fingerprint", "n_shingles", *SKETCH]
    sketches = texts.mapInArrow(_sketches(words), ", ".join(f"{c} long" for c in kinds) + ", bands array<long>")
    sketches = written(sketches.groupBy("content").agg(*(F.first(c).alias(c) for c in [*kinds[1:], "bands"])), "sketches")
    worded = sketches.where("n_shingles > 0")
    proposed = _propose_pairs(worded, radius, parts, similarity, most)
    links = written(_verified(written(proposed, "pairs"), texts, words, similarity).select("a", "b"), "similar")
    groups = written(components(links), "groups")
    proposed, dense = _propose_by_bands(worded, groups, similarity, most)
    found = written(_verified(written(proposed, "pairs"), texts, words, similarity).select("a", "b"), "similar")
    if not found.isEmpty():
        links = links.unionByName(found)
        groups = written(components(links), "groups")
    dense = written(dense, "dense")
    if dense.isEmpty():
        return groups
    more = written(_dense_links(dense, sketches, groups, texts, words, similarity), "dense-links")
    return written(components(links.unionByName(more)), "groups")


def _content(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


MAX_COLLISIONS = 100_000  # numbers that several texts share; some hundreds among 10^11 texts


def told_apart(docs: DataFrame, text: str = "text") -> Column:
    """A number for each text, other texts having others: its 64-bit hash, and a second hash where
    texts of other 128-bit digests share the first. Checked again until none do."""
    plain = F.coalesce(docs[text], F.lit(""))
    number, salt = _content(docs[text]), 0
    while True:
        digests = docs.select(number.alias("content"), F.md5(plain.cast("binary")).alias("digest")).groupBy("content").agg(
            F.min("digest").alias("low"), F.max("digest").alias("high"))
        shared = [r[0] for r in digests.where("low <> high").limit(MAX_COLLISIONS + 1).collect()]
        if not shared:
            return number
        if len(shared) > MAX_COLLISIONS:
            raise ValueError(f"over {MAX_COLLISIONS} numbers are shared by several texts")
        salt += 1
        number = F.when(number.isin(shared), F.xxhash64(plain, F.lit(salt))).otherwise(number)


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each group of similar texts, with all columns: the one with the smallest id.

    Texts are similar as in ``similar_groups`` or through others; equal texts are, too. A text
    without words is similar to equal ones only. A null id ranks behind all others; rows
    equal in text and id are thinned to the first by their other columns."""
    own = told_apart(docs, text)
    groups = similar_groups(docs, text, own=own, **how)
    rank = lambda c: F.struct(c.isNull().alias("missing"), c.alias("id"))
    ids = docs.select(own.alias("content"), rank(docs[doc_id]).alias("rank"))
    best = ids.groupBy("content").agg(F.min("rank").alias("rank"))
    grouped = best.join(groups.withColumnRenamed("node", "content"), "content", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "content"))
    stay = grouped.groupBy("root").agg(F.min_by(F.struct("content", "rank"), F.struct("rank", "content")).alias("kept"))
    stay = stay.select("kept.content", "kept.rank")
    rows = docs.select(packed(docs), own.alias("content"), rank(docs[doc_id]).alias("rank"))
    first = thinned(rows, docs, ["content", "rank"], (doc_id, text))
    return first.join(stay, ["content", "rank"], "left_semi").select("row.*")
