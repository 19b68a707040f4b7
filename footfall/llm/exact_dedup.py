"""Exact duplicates: Patricia-trie owners.

1. Every input partition inserts its texts, as whole byte strings, into a
   compressed radix trie. A terminal node stores the smallest and the largest
   identifier and the number of copies, so a text that a third of all rows repeat
   leaves a task as one row. When nodes and edges reach ``TRIE_BYTES``, the largest
   subtrees below the root are written out and freed until half is left.
2. What is left goes to partitions by (length, content hash) and is sorted there. A
   partition has one trie of (length, hash, byte string); equal texts follow each other, so
   when it is full and another length or hash begins, all subtrees are final: they are
   written out and freed. The hash only deals out the work: equality is decided by the trie.
3. Subtrees are keyed by the SHA-256 of their text, which documents look up.

Null counts as empty. With ``keep="max"`` the row with the largest id stays, with
``keep="min"`` that with the smallest; a null id ranks below all others. Rows that
repeat both text and id are still rows: the first of them stays. Columns other than
the id and the text may have any name and are not compared.
An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import packed, thinned
from footfall.session import carry_to_workers

carry_to_workers(__name__)

TRIE_BYTES = 64 << 20  # bytes that one trie may take before subtrees are written out
NODE_BYTES = 450       # of a node and its value besides the edge's bytes, as measured


class Trie:
    """A compressed radix trie. A node is ``[edge bytes, children by first byte, value]``;
    a value belongs to the byte string that ends at the node."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.size = 0  # bytes of edges and nodes

    def add(self, key: bytes, value, merge) -> None:
        node, at = self.root, 0
        while True:
            if at == len(key):
                node[2] = value if node[2] is None else merge(node[2], value)
                return
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, value]
                self.size += len(key) - at + NODE_BYTES
                return
            edge = child[0]
            if key.startswith(edge, at):
                node, at = child, at + len(edge)
                continue
            common = _common(edge, key, at)
            upper = [edge[:common], {edge[common]: child}, None]
            child[0] = edge[common:]
            node[1][key[at]] = upper
            self.size += NODE_BYTES
            node, at = upper, at + common

    def spill(self, least: int = 0) -> Iterator[tuple[bytes, object]]:
        """Takes out subtrees below the root, the largest first, until at most ``least`` bytes are left, and
        gives their items. What ends at the root stays."""
        ways = sorted(((_weight(child), first) for first, child in self.root[1].items()), reverse=True)
        for weight, first in ways:
            if self.size <= least:
                return
            child = self.root[1].pop(first)
            self.size -= weight
            yield from self.items(child)

    def items(self, start: list | None = None) -> Iterator[tuple[bytes, object]]:
        """Keys and values of the trie, or of a subtree below the root."""
        todo = [(start or self.root, b"")]
        while todo:
            node, above = todo.pop()
            key = above + node[0]
            if node[2] is not None:
                yield key, node[2]
            todo.extend((child, key) for child in node[1].values())


def _weight(node: list) -> int:
    """Bytes of a subtree, as ``Trie.size`` counts them."""
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        total += len(node[0]) + NODE_BYTES
        todo.extend(node[1].values())
    return total


def _common(edge: bytes, key: bytes, at: int) -> int:
    """Length of the common start of ``edge`` and ``key[at:]``, by bisection."""
    low, high = 0, min(len(edge), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(edge[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low


def _merge(a: tuple, b: tuple) -> tuple:
    ids = [x for x in (a[0], b[0]) if x is not None]
    tops = [x for x in (a[1], b[1]) if x is not None]
    return min(ids, default=None), max(tops, default=None), a[2] + b[2]


_PART = pa.schema([("length", pa.int64()), ("hash", pa.int64()), ("content", pa.binary()),
                   ("low", pa.int64()), ("high", pa.int64()), ("copies", pa.int64())])
_DONE = pa.schema([("text_sha256", pa.string()), ("low", pa.int64()), ("high", pa.int64()),
                   ("copies", pa.int64())])


def _hash(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little", signed=True)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows_of(items: Iterator[tuple[bytes, tuple]]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for content, value in items:
            rows.append((len(content), _hash(content), content, *value))
            held += len(content)
            if held > 8 << 20 or len(rows) >= 20_000:
                yield _batch(rows, _PART)
                rows, held = [], 0
        yield _batch(rows, _PART)

    trie = Trie()
    for batch in batches:
        for key, content in zip(batch.column(0).to_pylist(), batch.column(1)):
            trie.add(content.as_buffer().to_pybytes() if content.is_valid else b"", (key, key, 1), _merge)
            if trie.size > TRIE_BYTES:
                yield from rows_of(trie.spill(least=TRIE_BYTES // 2))
    yield from rows_of(trie.items())


def _place(length: int, hashed: int) -> bytes:
    """The start of a key of the second trie."""
    return length.to_bytes(8, "big") + hashed.to_bytes(8, "big", signed=True)


def _owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie, newest = Trie(), b""
    for batch in batches:
        out = []
        columns = [batch.column(i) for i in range(6)]
        plain = [c.to_pylist() if i != 2 else c for i, c in enumerate(columns)]
        for length, hashed, content, low, high, copies in zip(*plain):
            place = _place(length, hashed)
            if trie.size > TRIE_BYTES and place != newest:
                out += _finished(trie.spill())
            newest = place
            trie.add(place + content.as_buffer().to_pybytes(), (low, high, copies), _merge)
        yield _batch(out, _DONE)
    yield _batch(_finished(trie.items()), _DONE)


def _finished(items: Iterator[tuple[bytes, tuple]]) -> list[tuple]:
    return [(hashlib.sha256(key[16:]).hexdigest(), *value) for key, value in items]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def text_owners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct text: ``text_sha256, low, high, copies``."""
    plain = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].cast("binary").alias("content"))
    parts = plain.mapInArrow(
        _local, "length long, hash long, content binary, low long, high long, copies long")
    shuffled = parts.repartition("length", "hash").sortWithinPartitions("length", "hash")
    return shuffled.mapInArrow(_owners, "text_sha256 string, low long, high long, copies long")


def _sha(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def assign_owners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  keep: str = "max") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    owners = text_owners(docs, doc_id, text)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), _sha(docs[text]).alias("text_sha256"))
    # Rows equal in id and text are counted here and told apart again below.
    rows = rows.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("repeats"))
    chosen = owners.select(
        "text_sha256", F.col("high" if keep == "max" else "low").alias("keep_id"),
        F.col("copies").alias("group_size"))
    joined = rows.join(chosen, "text_sha256")
    repeat = F.explode(F.sequence(F.lit(1).cast("long"), "repeats"))
    return joined.withColumn("repeat", repeat).select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)).alias("kept"),
        "text_sha256")


def keep_owners(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                keep: str = "max") -> DataFrame:
    """The rows that stay, with all columns.

    Rows that repeat both text and id are thinned first, to the smallest by their
    other columns; that filter also runs before the shuffle. The rest look up the
    owner of their text in the same partitioning.
    """
    id_key = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    owners = text_owners(docs, doc_id, text).select(
        F.col("text_sha256").alias("sha"), id_key(F.col("high" if keep == "max" else "low")).alias("id"))
    rows = docs.select(packed(docs), _sha(docs[text]).alias("sha"), id_key(docs[doc_id].cast("long")).alias("id"))
    first = thinned(rows, docs, ["sha", "id"], (doc_id, text))
    return first.join(owners, ["sha", "id"], "left_semi").select("row.*")
