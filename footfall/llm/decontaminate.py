"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document if at least ``similarity`` of the item's distinct word
shingles stand in the document, however long that is.

* Items are partitioned by size (number of distinct shingles, in powers of two). An item
  of n shingles that is contained to a share of s lacks at most n - ceil(s n) of them, so
  of its n - ceil(s n) + 1 shingles with the smallest hashes at least one is in the
  document. That MinHash sketch, whose length follows from the size, is what documents
  are searched for: no item at the threshold can be missed.
* A document computes the hashes of its shingles, looks them up in the sketches, and
  compares the shingles themselves with those of each item found. Only words of the
  benchmark can be part of a match, so other words end a run at once.

Items go to the tasks in blocks of at most ``block_mb`` of text, one pass over the
documents for each block; the benchmark's size sets the number of blocks. Documents
are never shuffled and their whole texts are read.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` of the lower-cased text. Items with
fewer than five words are one shingle of their own length; items without words are never
found. Null texts have no words. Repeated items and documents give a row for each pair.
Other columns may have any name. An empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import word_list
from footfall.session import carry_to_workers

carry_to_workers(__name__)

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BLOCK_MB = 16

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _words(text: str | None) -> list[bytes]:
    return word_list(text.lower()) if text else []


def _needed(n: int, similarity: float) -> int:
    """Shingles of n that must be found: ceil(similarity n), free of rounding dust."""
    return max(1, int(np.ceil(similarity * n - 1e-9)))


def _hash(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` word codes."""
    n = max(len(codes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(size if n else 0):
        out = (out ^ codes[i:n + i]) * _FACTOR
        out ^= out >> np.uint64(29)
    return out


class Items:
    """The lookup tables for one block of items."""

    def __init__(self, items: list[tuple], size: int, similarity: float) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.similarity = similarity
        self.shingles: list[frozenset[tuple[int, ...]]] = []
        self.ids: list = []
        # Shingle length -> size class -> sketch hash -> items of that class.
        classes: dict[int, dict[int, dict[int, list[int]]]] = {}
        for item_id, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in _words(text)]
            if not codes:
                continue
            length = min(size, len(codes))
            found = sorted({tuple(codes[i:i + length]) for i in range(len(codes) - length + 1)})
            hashes = _hash(np.array(found, np.uint64).ravel(), length)[::length]
            sketch = np.sort(hashes)[:len(found) - _needed(len(found), similarity) + 1]
            at = len(self.ids)
            self.ids.append(item_id)
            self.shingles.append(frozenset(found))
            members = classes.setdefault(length, {}).setdefault(len(found).bit_length(), {})
            for h in sketch:
                members.setdefault(int(h), []).append(at)
        self.classes = classes
        self.keys = {length: np.sort(np.unique(np.array([h for c in by_size.values() for h in c], np.uint64)))
                     for length, by_size in classes.items()}

    def search(self, words: list[bytes]) -> list[tuple]:
        """(item id, shared shingles, shingles of the item) of all items found."""
        get = self.vocabulary.get
        codes = np.array([get(w, 0) for w in words], np.uint64)
        if not codes.any():
            return []
        candidates: set[int] = set()
        for length, keys in self.keys.items():
            hashes = _hash(codes, length)
            place = np.searchsorted(keys, hashes)
            hits = np.flatnonzero(keys[np.minimum(place, len(keys) - 1)] == hashes)
            for h in set(hashes[hits].tolist()):
                for members in self.classes[length].values():
                    candidates.update(members.get(h, ()))
        out, own = [], {}
        for at in sorted(candidates):
            wanted = self.shingles[at]
            length = len(next(iter(wanted)))
            if length not in own:
                own[length] = _known_shingles(codes, length)
            shared = len(wanted & own[length])
            if shared >= _needed(len(wanted), self.similarity):
                out.append((self.ids[at], shared, len(wanted)))
        return out


def _known_shingles(codes: np.ndarray, length: int) -> set[tuple[int, ...]]:
    """Shingles of the document that consist of benchmark words alone."""
    known = codes > 0
    run = np.convolve(known, np.ones(length, np.int64), "valid") == length
    plain = codes.tolist()
    return {tuple(plain[i:i + length]) for i in np.flatnonzero(run)}


def _blocks(benchmark: DataFrame, item_id: str, item_text: str, block_mb: float) -> Iterator:
    """The benchmark in broadcast blocks of about ``block_mb`` of text, the size checked first."""
    items = benchmark.select(benchmark[item_id].cast("long").alias("item_id"), benchmark[item_text].alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // int(block_mb * (1 << 20))))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield benchmark.sparkSession.sparkContext.broadcast([tuple(r) for r in part.collect()])


_KINDS = [pa.int64(), pa.float64(), pa.int64(), pa.int64()]


def find_items(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", size: int = SHINGLE_WORDS,
               similarity: float = SIMILARITY, block_mb: float = BLOCK_MB) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, containment, shared,
    item_shingles``."""
    plain = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def search(carried) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = Items(carried.value, size, similarity)
            for batch in batches:
                rows, places = [], []
                for i, t in enumerate(batch.column(1)):
                    for item, shared, n in held.search(_words(t.as_py())):
                        places.append(i)
                        rows.append((item, shared / n, shared, n))
                columns = list(zip(*rows)) or [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(places, pa.int64())),
                     *(pa.array(c, k) for c, k in zip(columns, _KINDS))],
                    ["doc_id", "item_id", "containment", "shared", "item_shingles"])

        return plain.mapInArrow(
            run, f"doc_id {kind}, item_id long, containment double, shared long, item_shingles long")

    return reduce(DataFrame.unionByName, map(search, _blocks(benchmark, item_id, item_text, block_mb)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", size: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                      block_mb: float = BLOCK_MB) -> DataFrame:
    """The rows in whose text no item was found, with all columns; each row is judged by
    its own text, so equal or missing ids do not matter."""
    at = docs.columns.index(text)
    for carried in _blocks(benchmark, item_id, item_text, block_mb):
        def run(batches: Iterator[pa.RecordBatch], carried=carried) -> Iterator[pa.RecordBatch]:
            held = Items(carried.value, size, similarity)
            for batch in batches:
                clean = [not held.search(_words(t.as_py())) for t in batch.column(at)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
