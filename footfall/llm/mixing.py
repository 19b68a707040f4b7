"""Mixing sources to target weights.

1. Tokens (here: words) of a source stand in one line, documents in the order of
   ``order_key``, and are packed into blocks of a fixed number of tokens. A document's
   place comes from a prefix sum in two levels: over buckets of a source, then within
   a bucket; no source is ever in one task.
2. Targets follow the weights. A target stops at ``max_repeats`` times the source's
   size; the excess goes to the others by weight until none is above. This is found
   by aggregates over the table of sources.
3. A source has as many slots as its target fills. Each slot draws an output shard, so
   the source counts of a shard are multinomial, with the totals held to the targets.
4. Slot ``s`` of a source reads block ``permutation(s)``: a keyed Feistel network on the
   block numbers, another one for each pass over the source. Within a pass every block
   comes once, so no token comes more than ``max_repeats`` times. The short last block
   stands last in its pass, and the last slot of all is cut to the tokens still missing.
5. Slots and blocks are joined by (source, block).

A null text counts zero tokens, a null source is a source of its own and comes last.
Documents of equal source and id are ordered by size and a hash of the text; rows equal in all of that
are interchangeable. All draws hash the seed, source and slot, so reruns agree. Empty tables give
empty results.
Other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import written
from footfall.session import carry_to_workers

carry_to_workers(__name__)

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
BLOCK_TOKENS = 128
BUCKETS = 1024        # of a source, for the prefix sum
SLOTS_PER_ROW = 4096  # slots that one row of the slot table is spread to
SLOTS_PER_TASK = 50_000  # slots that one task unfolds
SHARDS = 64
SEED = 20_240_917

SPACE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds ``name``, the place of a row in the whole order from 0, without one task for
    all rows: ranges are numbered by themselves, then shifted by the rows before them."""
    ranges = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row per task
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranges.join(counts, "_range").withColumn(name, inside + F.col("_before")).drop("_range", "_before")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` of ``sizes (source, size, copies)``.

    Weights repeat over the sources in code-point order, null last. A target is
    ``min(max_repeats x size, weight x level)``; the level is raised until the targets
    share all sizes."""
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    placed = ranked(sources, [F.col("source").isNull().asc(), F.col("source").asc()], "place")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    placed = written(placed.select("source", "source_size", weight.alias("weight"),
                                   (F.col("source_size") * max_repeats).cast("double").alias("most")), "sources")
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        # Each round adds the sources that the last level filled; the level only rises.
        capped = F.col("most") <= F.col("weight") * F.lit(level)
        row = placed.agg(F.sum(F.when(capped, F.col("most"))), F.sum(F.when(~capped, F.col("weight"))),
                         F.count(F.when(capped, 1))).first()
        if row[1] is None or row[2] == full:
            break
        full, level = row[2], (total - (row[0] or 0.0)) / row[1]
    return placed.select("source", "source_size", F.least(F.col("most"), F.col("weight") * level).alias("target"))


def place_documents(rows: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Adds ``at``, the tokens of the same source before a document, to rows of
    ``sized``; a row that stands for several copies becomes one row for each."""
    bucket = F.pmod(F.xxhash64(*ORDER), F.lit(buckets))
    rows = rows.withColumns({"_bucket": bucket, "_all": F.col("size") * F.col("copies")})
    totals = rows.groupBy("source", "_bucket").agg(F.sum("_all").alias("_size"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("source").alias("_source"), F.col("_bucket").alias("_b"),
                           F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_bucket").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_all").over(inside), F.lit(0)))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return rows.join(starts, same).withColumn("_copy", copy).withColumn(
        "at", F.col("_start") + F.col("_inside") + F.col("_copy") * F.col("size")).drop(
        "_bucket", "_source", "_b", "_start", "_inside", "_all", "_copy", "copies")


_GOLDEN = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: multiply and shift until all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray, rounds: int = 4) -> np.ndarray:
    """``index`` under a pseudorandom permutation of ``range(size)`` named by ``key``.

    A Feistel network over the next even number of bits; values that leave the range
    walk on until they return, which keeps it a permutation."""
    size, key = size.astype(np.uint64), key.astype(np.uint64)
    out, todo = index.astype(np.uint64).copy(), np.flatnonzero(size > 1)
    bits = np.ceil(np.log2(np.maximum(size, 2).astype(np.float64)) / 2).astype(np.uint64)
    bits = np.maximum(bits, np.uint64(1))
    bits += (np.uint64(1) << (bits * np.uint64(2))) < size  # where the logarithm was rounded down
    while len(todo):
        x, half = out[todo], bits[todo]
        mask = (np.uint64(1) << half) - np.uint64(1)
        left, right = x >> half, x & mask
        for r in range(rounds):
            left, right = right, left ^ (_mix(right + key[todo] + np.uint64(r * _GOLDEN & (1 << 64) - 1)) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= size[todo]]
    return out.astype(np.int64)


def _slot_blocks(seed: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, slot, blocks, full = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3, 4))
            with np.errstate(over="ignore"):
                turn, place = slot // np.maximum(blocks, 1), slot % np.maximum(blocks, 1)
                key = _mix(code.astype(np.uint64) + np.uint64(seed) + _mix(turn.astype(np.uint64)))
                # The short last block, if any, stands last in each pass.
                block = np.where(place < full, permute(np.minimum(place, np.maximum(full - 1, 0)), full, key), place)
                shard = (_mix(key + slot.astype(np.uint64) + np.uint64(1)) % np.uint64(shards)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(block), pa.array(shard)], [*batch.schema.names, "block", "shard"])
    return run


def draw_slots(targets: DataFrame, block_tokens: int = BLOCK_TOKENS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per slot: ``source, slot, block, shard, tokens`` (how many it takes)."""
    size, b = F.col("source_size"), F.lit(block_tokens)
    goal = F.round("target").cast("long")
    passes = F.floor(goal / size)
    rest = goal - passes * size
    blocks = F.ceil(size / b).cast("long")
    plan = targets.where("source_size > 0 AND target > 0").select(
        "source", F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), F.lit(seed)).alias("code"),
        size.alias("size"), blocks.alias("blocks"), F.floor(size / b).cast("long").alias("full"),
        passes.cast("long").alias("passes"), rest.cast("long").alias("rest"),
        (passes * blocks + F.ceil(rest / b)).cast("long").alias("slots")).where("slots > 0")
    step = F.lit(SLOTS_PER_ROW).cast("long")
    spread = plan.withColumn("first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, step)))
    # A stated number of tasks: the rows are few, and would else be folded into one that unfolds all slots.
    tasks = -(-(plan.agg(F.sum("slots")).first()[0] or 1) // SLOTS_PER_TASK)
    spread = spread.repartition(tasks, "code", "first").withColumn(
        "slot", F.explode(F.sequence(F.col("first"), F.least(F.col("first") + step, F.col("slots")) - 1)))
    kind = targets.schema["source"].dataType.simpleString()
    names = ["source", "code", "slot", "blocks", "full", "size", "passes", "rest"]
    slots = spread.select(*names).mapInArrow(
        _slot_blocks(seed, shards),
        f"source {kind}, code long, slot long, blocks long, full long, size long, passes long, rest long, "
        "block long, shard long")
    length = F.least(b.cast("long"), F.col("size") - F.col("block") * b)
    last = F.floor(F.col("slot") / F.col("blocks")) == F.col("passes")
    tokens = F.when(last, F.least(length, F.col("rest") - (F.col("slot") % F.col("blocks")) * b)).otherwise(length)
    return slots.select("source", "slot", "block", "shard", tokens.cast("long").alias("tokens"))


ORDER = ["doc_id", "size", "content"]


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, size, content`` (a hash of the text) and how many rows are equal in these."""
    rows = docs.select(
        docs[doc_id].alias("doc_id"), docs[source].cast("string").alias("source"),
        word_count(docs[text]).alias("size"), F.xxhash64(docs[text]).alias("content"))
    return rows.groupBy("source", *ORDER).agg(F.count(F.lit(1)).alias("copies"))


def _pieces(placed: DataFrame, block_tokens: int) -> DataFrame:
    """A row per document and block that it reaches into: ``block``, and the document's
    first token in it (``low``) and the token behind its last (``high``), from the block's start."""
    b = F.lit(block_tokens)
    blocks = F.sequence(F.floor(F.col("at") / b), F.floor((F.col("at") + F.col("size") - 1) / b))
    return placed.where("size > 0").withColumn("block", F.explode(blocks)).withColumns({
        "low": F.greatest(F.lit(0).cast("long"), F.col("at") - F.col("block") * b),
        "high": F.least(b.cast("long"), F.col("at") + F.col("size") - F.col("block") * b)})


def _same_block(pieces: DataFrame, others: DataFrame) -> Column:
    return pieces["source"].eqNullSafe(others["_source"]) & (pieces["block"] == others["_block"])


def mix_shares(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
               block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``, the tokens of it
    that the mix takes. The text is only read to count its tokens."""
    rows = written(sized(docs, doc_id, text, source), "sizes")
    targets = written(source_targets(rows, weights, max_repeats), "targets")
    takes = draw_slots(targets, block_tokens, seed=seed).groupBy(
        F.col("source").alias("_source"), F.col("block").alias("_block")).agg(
        F.collect_list("tokens").alias("lengths"))  # max_repeats at most
    placed = place_documents(rows)
    pieces = _pieces(placed, block_tokens)
    part = F.aggregate(F.coalesce("lengths", F.array().cast("array<bigint>")), F.lit(0).cast("long"),
                       lambda total, n: total + F.greatest(
                           F.lit(0).cast("long"), F.least(n, F.col("high")) - F.col("low")))
    # Slots unfold from the small table of sources, so their number is hidden from the
    # planner; without the hint it would broadcast them.
    taken = pieces.join(takes.hint("merge"), _same_block(pieces, takes), "left").groupBy("source", "at").agg(
        F.any_value("doc_id").alias("doc_id"), F.any_value("size").alias("size"), F.sum(part).alias("taken"))
    empty = placed.where("size = 0").select("source", "at", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    shares, goal = taken.unionByName(empty), targets.withColumnRenamed("source", "_source")
    return shares.join(goal, shares["source"].eqNullSafe(goal["_source"])).select(
        "doc_id", "size", "source_size", "target", "taken")


def _cut(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for doc_id, source, at, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words, start = text.encode("utf-8", "surrogatepass").split(), 0
                while start < len(words):
                    block, low = divmod(at + start, block_tokens)
                    stop = min(len(words), start + block_tokens - low)
                    piece = b" ".join(words[start:stop]).decode("utf-8", "surrogatepass")
                    for column, value in zip(out, (doc_id, source, block, low, low + stop - start, piece)):
                        column.append(value)
                    start = stop
            kinds = [batch.schema.field(0).type, pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "source", "block", "low", "high", "piece"])
    return run


def mix_blocks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
               block_tokens: int = BLOCK_TOKENS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself: ``shard, source, slot, block, low, doc_id, n_words, text``, a row for
    each part of a document in each slot; ``low`` orders the parts of a slot."""
    rows = written(sized(docs, doc_id, text, source), "sizes")
    targets = written(source_targets(rows, weights, max_repeats), "targets")
    slots = draw_slots(targets, block_tokens, shards, seed).select(
        F.col("source").alias("_source"), F.col("block").alias("_block"), "slot", "shard", "tokens")
    # Copies of one row stand side by side; the text is joined to the first and shared by the rest.
    full = docs.select(docs[doc_id].alias("doc_id"), docs[source].cast("string").alias("source"),
                       F.xxhash64(docs[text]).alias("content"), docs[text].alias("text")).where(
        word_count(F.col("text")) > 0)
    one = Window.partitionBy("doc_id", "source", "content").orderBy("doc_id")
    full = full.withColumn("_n", F.row_number().over(one)).where("_n = 1").drop("_n")
    placed = place_documents(rows).where("size > 0").alias("p")
    met = placed.join(full.alias("f"), (F.col("p.content") == F.col("f.content"))
                      & F.col("p.doc_id").eqNullSafe(F.col("f.doc_id"))
                      & F.col("p.source").eqNullSafe(F.col("f.source")))
    kind = docs.schema[doc_id].dataType.simpleString()
    pieces = met.select("p.doc_id", "p.source", "p.at", "f.text").mapInArrow(
        _cut(block_tokens), f"doc_id {kind}, source string, block long, low long, high long, piece string")
    taken = F.least(F.col("tokens"), F.col("high")) - F.col("low")
    words = F.split("piece", " ")
    return pieces.join(slots.hint("merge"), _same_block(pieces, slots)).where("tokens > low").select(
        "shard", "source", "slot", "block", "low", "doc_id", taken.alias("n_words"),
        F.when(F.col("tokens") >= F.col("high"), F.col("piece")).otherwise(
            F.array_join(F.slice(words, F.lit(1), taken.cast("int")), " ")).alias("text"))
