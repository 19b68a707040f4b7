"""Similarity join of shingle sets by T-occurrence search.

Two documents link when the Jaccard similarity of their sets of distinct word shingles is
``percent`` / 100 or more. A partner of a set of n shingles therefore shares at least
T = ceil(percent * n / 100) of them. The join finds, for every set, the sets that occur in at least
T of its shingles' inverted lists.

1. **Sets.** One row per document; documents with equal sets are one set from here on.
2. **Pruning.** The smallest n - T + l shingles by hash of two linked sets have at least
   l' = min of both l in common (what one lacks of the other is at most n - T). A set with fewer
   than that many shingles which occur in any other set has no partner and leaves; most documents do.
   Of what is left all shingles are looked at in the same way: T of them have to occur elsewhere.
   A task folds the shingles it holds, so a frequent one leaves it as one row.
3. **Blocks.** What remains is ordered so that sets with probed shingles in common lie together (by
   components of stars around the first set that holds a shingle), and cut into blocks of
   ``BLOCK_SHINGLES``, however it is partitioned. Each block has an inverted index. The order decides
   only how much has to travel between blocks.
4. **Search** (DivideSkip). Of a query's lists the L longest are set aside; the short ones are
   merged on a heap that skips to where T - L of them can still agree (by sorting where they hold
   more than ``HEAP_ENTRIES``); what occurs often enough there is looked up in the long lists by binary
   search. A set that is found is linked and leaves the index, so a dense group of sets costs
   about one search a member, not all pairs.
5. **Stars.** Groups that span blocks are joined first: for the probed shingles each group sends one
   set to a block of the first group that holds them, where it shares enough with it. That is linear
   in the shingles.
6. **Routes.** Then a set is sent to another block if the shingles it shares with that block's sets of
   other groups reach the bound of step 2. That is exact. Only sets that share most of their probe but
   are not linked still cost rows as the square of their number, divided by the sets of a block.

Shingles are compared by 64-bit hashes. Only sets that share most of their shingles can be judged
wrongly, if two different shingles of one pair collide: for sets of 1000 shingles about 1 pair in
10^13 at the very threshold. Sets are told apart by 128 bits.

Fewer words than a shingle has give one shingle, the whole sequence; no words or a null text give
the empty set, which links with nothing. A null id is never the smallest unless all ids of a group
are null. Repeated rows are rows. Very long texts are taken whole. An empty table gives no rows.
Columns other than the id and the text are not read and may have any name.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import written
from footfall.llm.components import components
from footfall.llm.simhash import _fold, shingle_hashes
from footfall.session import carry_to_workers

carry_to_workers(__name__)

PERCENT, WORDS = 85, 4
PROBE_SHARE = 20            # l is a twentieth of a set
FOLD_SHINGLES = 1 << 20     # shingles that a task folds at a time
BLOCK_SHINGLES = 1 << 19    # shingles in one block's index
HEAP_ENTRIES = 2_048        # entries of short lists that are merged on a heap
STARS = 3                   # rounds of step 5, fewer if one links nothing
QUERY_ROWS = 20_000         # sets sent to one copy of a block
LONG_LISTS = 0.0085         # weight of a list's length in the choice of L


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """T: shingles that a set of ``n`` shares with every partner, at least."""
    return -(-percent * n // 100)


def _extra(n: int) -> int:
    return -(-n // PROBE_SHARE)


def probe_length(n: int, percent: int = PERCENT) -> int:
    """How many of the smallest shingles of a set are probed."""
    return min(n, n - least_overlap(n, percent) + _extra(n)) if n else 0


def least_probes(n: int, percent: int = PERCENT) -> int:
    """How many of them are shared with every partner, at least. A partner is no smaller than T."""
    return _extra(least_overlap(n, percent))


def linked(shared: int, n: int, m: int, percent: int = PERCENT) -> bool:
    return 100 * shared >= percent * (n + m - shared)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles as sorted unsigned 64-bit hashes."""
    return np.unique(shingle_hashes(_fold(text), words).reshape(-1).view(np.uint64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    lengths = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(lengths), pa.array(values.view(np.int64)))


def _arrays(column: pa.Array) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy().view(np.uint64), np.cumsum(column.value_lengths().to_numpy())
    return np.split(flat, ends[:-1]) if len(ends) else []


# --------------------------------------------------------------- the search


class Index:
    """Inverted lists over sets, which are numbered by ascending size so that the sizes a query
    admits are one range of every list. Sets can be taken out."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = np.argsort([len(s) for s in sets], kind="stable")
        self.sets = [sets[i] for i in self.order]
        self.place = {int(old): new for new, old in enumerate(self.order)}
        self.sizes = [len(s) for s in self.sets]
        self.alive = np.ones(len(sets), bool)
        self._build()

    def _build(self) -> None:
        own = np.flatnonzero(self.alive)
        self.held = self.left = len(own)
        owner = np.repeat(own, [self.sizes[i] for i in own]) if len(own) else np.empty(0, np.int64)
        tokens = np.concatenate([self.sets[i] for i in own]) if len(own) else np.empty(0, np.uint64)
        order = np.argsort(tokens, kind="stable")
        self.tokens, first = np.unique(tokens[order], return_index=True)
        self.owner, self.bounds = owner[order], np.append(first, len(tokens))

    def remove(self, place: int) -> None:
        if self.alive[place]:
            self.alive[place] = False
            self.left -= 1

    def search(self, query: np.ndarray, percent: int, wanted: np.ndarray | None = None) -> list[int]:
        """Places of all sets linked with ``query`` that are in the index (and ``wanted``)."""
        if self.left * 2 < self.held:
            self._build()
        n = len(query)
        if not self.left or not n:
            return []
        low = bisect_left(self.sizes, least_overlap(n, percent))
        high = bisect_right(self.sizes, 100 * n // percent)
        at = np.searchsorted(self.tokens, query)
        at = at[(at < len(self.tokens)) & (self.tokens[np.minimum(at, len(self.tokens) - 1)] == query)]
        least = least_overlap(n, percent)
        if low >= high or len(at) < least:
            return []
        # All entries of the query's lists, cut down to admitted sets, and cut into lists again.
        first, length = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        ends = np.cumsum(length)
        flat = self.owner[np.repeat(first - ends + length, length) + np.arange(ends[-1])]
        admit = self.alive if wanted is None else self.alive & wanted
        keep = (flat >= low) & (flat < high) & admit[flat]
        length = np.bincount(np.repeat(np.arange(len(at)), length)[keep], minlength=len(at))
        lists = [x for x in np.split(flat[keep], np.cumsum(length)[:-1]) if len(x)]
        places, shared = divide_skip(lists, least)
        return [p for p, c in zip(places.tolist(), shared.tolist()) if linked(c, n, self.sizes[p], percent)]


def divide_skip(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that occur in at least ``least`` of the sorted lists, and how often they do."""
    if least < 1:
        raise ValueError("a T-occurrence search needs T of 1 or more")
    none = np.empty(0, np.int64)
    if len(lists) < least:
        return none, none
    lists = sorted(lists, key=len)
    aside = min(least - 1, int(least / (LONG_LISTS * math.log(len(lists[-1]) + 1) + 1)))
    short, long = lists[:len(lists) - aside], lists[len(lists) - aside:]
    if sum(map(len, short)) <= HEAP_ENTRIES:
        found = list(merge_skip([x.tolist() for x in short], least - aside))
        numbers, counts = (np.array(x, np.int64) for x in zip(*found)) if found else (none, none)
    else:
        numbers, counts = np.unique(np.concatenate(short), return_counts=True)
        numbers, counts = numbers[counts >= least - aside], counts[counts >= least - aside]
    for i, entries in enumerate(long):
        if not len(numbers):
            break
        at = np.minimum(np.searchsorted(entries, numbers), len(entries) - 1)
        counts = counts + (entries[at] == numbers)
        if i % 8 == 7:
            keep = counts + len(long) - i - 1 >= least
            numbers, counts = numbers[keep], counts[keep]
    return numbers[counts >= least], counts[counts >= least]


def merge_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """Numbers in at least ``least`` of the sorted lists, with the count, merged on a heap. Where the
    smallest number occurs too rarely, ``least - 1`` lists jump to the next number that can occur
    often enough."""
    at = [0] * len(lists)
    heap = [(entries[0], i) for i, entries in enumerate(lists) if entries]
    heapq.heapify(heap)
    while len(heap) >= least:
        number, popped = heap[0][0], []
        while heap and heap[0][0] == number:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= least:
            yield number, len(popped)
            goal = number + 1
        else:
            while heap and len(popped) < least - 1:
                popped.append(heapq.heappop(heap)[1])
            goal = heap[0][0] if heap else None
        if goal is None:
            return
        for i in popped:
            at[i] = bisect_left(lists[i], goal, at[i])
            if at[i] < len(lists[i]):
                heapq.heappush(heap, (lists[i][at[i]], i))


def connect(sets: list[np.ndarray], percent: int = PERCENT) -> list[int]:
    """For each set the first set of its group: groups are connected by links. What is found leaves
    the index."""
    index, root = Index(sets), list(range(len(sets)))
    for start in range(len(sets)):
        place = index.place[start]
        if not index.alive[place]:
            continue
        index.remove(place)
        todo = [place]
        while todo and index.left:
            for found in index.search(index.sets[todo.pop()], percent):
                index.remove(found)
                root[int(index.order[found])] = start
                todo.append(found)
    return root


# ------------------------------------------------------------------ pruning


def _documents(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(keys, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 _lists([s[:probe_length(len(s), percent)] for s in sets])],
                ["doc_id", "content", "key", "n", "probe"])
    return run


def _fold_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``shingle, id, n``: a shingle that one set of a fold holds, with that set; one of several, without
    (n = 0); and for each set the shingles it shares within the fold (n > 0, under a number of its own)."""
    def flush(ids: list[np.ndarray], arrays: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        # Equal sets are one set: only the first of an id counts.
        _, first = np.unique(np.concatenate(ids), return_index=True)
        own = np.concatenate(ids)[first]
        arrays = [arrays[i] for i in first]
        owner = np.repeat(np.arange(len(own)), [len(a) for a in arrays])
        shingles, place, count = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        several = count[place] > 1
        shared = np.bincount(owner[several], minlength=len(own))
        some = np.flatnonzero(shared)
        single = ~several
        keys = np.concatenate((shingles[count > 1].view(np.int64), np.concatenate(arrays)[single].view(np.int64), own[some]))
        idle = np.zeros((count > 1).sum(), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(np.concatenate((idle, own[owner[single]], own[some]))),
             pa.array(np.concatenate((idle - 1, np.zeros(single.sum(), np.int64), shared[some])))],
            ["shingle", "id", "n"])

    ids, arrays, held = [], [], 0
    for batch in batches:
        ids.append(batch.column(0).to_numpy())
        arrays += _arrays(batch.column(1))
        held += len(batch.column(1).flatten())
        if held > FOLD_SHINGLES:
            yield from flush(ids, arrays)
            ids, arrays, held = [], [], 0
    if arrays:
        yield from flush(ids, arrays)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, n`` of sorted rows: 1 for each shingle of a set that occurs in another, and what was
    counted before. Rows that repeat (copies in other folds) are one. A run of equal shingles is never
    held: a row waits for the next."""
    waiting, met_before = None, False
    for batch in batches:
        shingle, ids, n = (batch.column(i).to_numpy() for i in range(3))
        counted = n > 0
        if counted.any():
            yield pa.RecordBatch.from_arrays([pa.array(ids[counted]), pa.array(n[counted])], ["id", "n"])
        rows = np.stack((shingle, ids, n))[:, ~counted]
        if waiting is not None:
            rows = np.concatenate((waiting, rows), 1)
        if not rows.shape[1]:
            continue
        rows = rows[:, np.concatenate(([True], (rows[:, 1:] != rows[:, :-1]).any(0)))]
        same = rows[0, 1:] == rows[0, :-1]
        met = np.concatenate(([met_before], same)) | np.concatenate((same, [False]))
        done = (met & (rows[2] == 0))[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(rows[1, :-1][done]), pa.array(np.ones(done.sum(), np.int64))], ["id", "n"])
        waiting, met_before = rows[:, -1:], bool(met[-1])
    if waiting is not None and met_before and waiting[2, 0] == 0:
        yield pa.RecordBatch.from_arrays([pa.array(waiting[1]), pa.array(np.ones(1, np.int64))], ["id", "n"])


def _shared_counts(sets: DataFrame) -> DataFrame:
    """``id, shared`` of ``sets (id, shingles)``: how many shingles of a set other sets hold as well."""
    folded = sets.mapInArrow(_fold_shingles, "shingle long, id long, n long")
    sorted_rows = folded.repartition("shingle").sortWithinPartitions("shingle", "id", "n")
    return sorted_rows.mapInArrow(_shared, "id long, n long").groupBy("id").agg(F.sum("n").alias("shared"))


# ------------------------------------------------------------------- blocks


def _key_id(key: Column) -> Column:
    """64 bits of a set's key, for counting only: a collision keeps a set, it loses none."""
    return F.xxhash64(key)


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, first = np.unique(np.array([*batch.column(0).to_pylist(), None], object)[:-1], return_index=True)
            texts = batch.column(1).take(pa.array(np.sort(first)))
            keys = batch.column(0).take(pa.array(np.sort(first)))  # copies of a text come together
            yield pa.RecordBatch.from_arrays([keys, _lists([shingle_set(t.as_py(), words) for t in texts])], ["key", "shingles"])
    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``id, shingles`` with the task's number and the shingles of the task's rows before."""
    task, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        ends = before + np.cumsum(batch.column(1).value_lengths().to_numpy().astype(np.int64))
        starts = np.concatenate(([before], ends[:-1])) if len(ends) else ends
        before = int(ends[-1]) if len(ends) else before
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(starts), task, np.int64)), pa.array(starts)],
            ["id", "shingles", "task", "before"])


_PLACED = "id long, block long, root long, shingles array<long>"


def _place(percent: int):
    """Connects the sets of each block; rows come sorted by block. ``root`` is the id of the first set of the
    group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, ids, sets = None, [], []

        def flush() -> pa.RecordBatch:
            root = connect(sets, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array([here] * len(ids), pa.int64()), pa.array([ids[r] for r in root]), _lists(sets)],
                ["id", "block", "root", "shingles"])

        for batch in batches:
            plain = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for block, own, shingles in zip(*plain, _arrays(batch.column(2))):
                if block != here:
                    if ids:
                        yield flush()
                    here, ids, sets = block, [], []
                ids.append(own)
                sets.append(shingles)
        if ids:
            yield flush()
    return run


def _probes(sets: DataFrame, percent: int, *columns: str) -> DataFrame:
    """The probed shingles of each set, with ``least``, how many of them it shares with every partner."""
    n = F.size("shingles")
    least = F.ceil(percent * n / F.lit(100))
    extra = lambda c: F.ceil(c / PROBE_SHARE)
    length = F.least(n, n - least + extra(n)).cast("int")
    return sets.select(*columns, extra(least).alias("least"), F.explode(F.slice("shingles", F.lit(1), length)).alias("shingle"))


def _neighbourhoods(sets: DataFrame, percent: int) -> DataFrame:
    """``id, near``: equal ``near`` for sets that probably have much in common; for placing them only."""
    rows = _probes(sets, percent, "id")
    first = rows.groupBy("shingle").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    stars = rows.join(first, "shingle").where("id <> first").groupBy("id", "first", "least").agg(F.count(F.lit(1)).alias("n"))
    named = components(stars.where(F.col("n") * 4 >= F.col("least")).select(F.col("id").alias("a"), F.col("first").alias("b")))
    return named.select(F.col("node").alias("id"), F.col("root").alias("near"))


def _placed(sets: DataFrame, percent: int) -> DataFrame:
    """``id, block, root, shingles``: sets in order of their neighbourhoods, cut into blocks of like size."""
    tokens = sets.agg(F.sum(F.size("shingles").cast("long"))).first()[0] or 0
    near = sets.join(_neighbourhoods(sets, percent), "id", "left").select(
        "id", "shingles", F.coalesce("near", "id").alias("near"))
    order = [F.col("near"), F.col("shingles")[0], F.col("id")]
    running = near.repartitionByRange(max(1, math.ceil(tokens / BLOCK_SHINGLES)), *order).sortWithinPartitions(*order)
    running = written(running.select("id", "shingles").mapInArrow(
        _running, "id long, shingles array<long>, task long, before long"), "overlap-order")
    # One row a task; what the tasks before hold.
    tasks = running.groupBy("task").agg(F.sum(F.size("shingles").cast("long")).alias("held"))
    above = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("task", F.coalesce(F.sum("held").over(above), F.lit(0)).alias("above"))
    rows = running.join(tasks, "task").select(
        F.floor((F.col("above") + F.col("before")) / BLOCK_SHINGLES).alias("block"), "id", "shingles")
    rows = rows.repartition("block").sortWithinPartitions("block", "id")
    return written(rows.mapInArrow(_place(percent), _PLACED), "overlap-blocks")


def _topped(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the group that their root belongs to by now."""
    return rows.join(roots, "root", "left").withColumn("root", F.coalesce("top", "root")).drop("top")


def _contested(probes: DataFrame) -> DataFrame:
    """Rows whose shingle several groups hold."""
    several = probes.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return probes.join(several.select("shingle"), "shingle", "left_semi")


def _star_routes(probes: DataFrame) -> DataFrame:
    """``id, root, block``: of each group a set that shares enough with the first groups of its shingles, for
    a block of theirs."""
    first = probes.groupBy("shingle").agg(F.min(F.struct("root", "block")).alias("first"))
    met = probes.join(first, "shingle").where(F.col("root") != F.col("first.root")).groupBy(
        "id", "root", "least", F.col("first.block").alias("block")).agg(F.count(F.lit(1)).alias("shared"))
    return met.where("shared >= least").groupBy("root", "block").agg(F.min("id").alias("id")).select("id", "root", "block")


def _routes(probes: DataFrame) -> DataFrame:
    """``id, root, block``: sets and the other blocks whose sets of other groups share enough of their probe."""
    held = probes.groupBy("shingle", "block").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    met = probes.withColumnRenamed("block", "own").join(held, "shingle").where(
        (F.col("block") != F.col("own")) & ((F.col("low") != F.col("root")) | (F.col("high") != F.col("root"))))
    return met.groupBy("id", "root", "least", "block").agg(F.count(F.lit(1)).alias("shared")).where(
        "shared >= least").select("id", "root", "block")


def _answer(percent: int):
    """Links ``a, b`` between groups. Rows of a (block, slice) come with its own sets first, then the
    queries by group; the index holds one block, queries pass by. A pair of groups is linked once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sets, roots, index = None, [], [], None

        for batch in batches:
            found = []
            plain = [batch.column(i).to_pylist() for i in range(4)]
            for block, part, query, root, own in zip(*plain, _arrays(batch.column(4))):
                if (block, part) != here:
                    here, sets, roots, index = (block, part), [], [], None
                if not query:
                    sets.append(own)
                    roots.append(root)
                    continue
                if index is None:
                    index = Index(sets)
                    names = [roots[int(i)] for i in index.order]
                    number: dict[int, int] = {}  # groups; joined groups share one
                    of = np.array([number.setdefault(r, len(number)) for r in names])
                mine = number.setdefault(root, len(number))
                wanted = of != mine
                if not wanted.any():
                    continue
                for place in index.search(own, percent, wanted):
                    if of[place] != mine:
                        found.append((root, names[place]))
                        of[of == of[place]] = mine
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], ["a", "b"])
    return run


def _links(placed: DataFrame, routes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between the groups of routed sets and those of the blocks they are sent to."""
    slices = routes.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("slices"))
    held = _topped(placed, roots).join(slices, "block").select(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"),
        F.lit(False).alias("query"), "root", "shingles")
    asked = routes.join(slices, "block").join(placed.select("id", "shingles"), "id").select(
        "block", F.pmod(F.xxhash64("root"), "slices").alias("slice"), F.lit(True).alias("query"), "root", "shingles")
    rows = held.unionByName(asked).repartition("block", "slice").sortWithinPartitions("block", "slice", "query", "root")
    return rows.mapInArrow(_answer(percent), "a long, b long")


def _joined(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("root"), F.col("root").alias("top"))


def link_sets(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``id, root`` of ``sets (id, shingles)``, distinct sets of sorted shingles: equal roots for sets
    connected by links."""
    placed = _placed(sets, percent)
    probes = written(_contested(_probes(placed, percent, "id", "block", "root")), "overlap-probes")
    roots = placed.select("root", F.col("root").alias("top")).where("false")
    links, turn = None, 0
    while turn <= STARS:
        routes = written(_routes(probes) if turn == STARS else _star_routes(probes), "overlap-routes")
        found = written(_links(placed, routes, roots, percent), "overlap-links")
        if found.isEmpty():
            turn = max(turn + 1, STARS)  # further stars would send the same sets
            continue
        links = found if links is None else links.unionByName(found)
        roots = written(_joined(links), "overlap-roots")
        probes = written(_contested(_topped(probes, roots)), "overlap-probes")
        turn += 1
    return _topped(placed, roots).select("id", "root")


def join_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                 percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, set_id`` (hex; equal sets are one), ``n_equal``, how
    many rows hold that set, and ``component_id``, the smallest id that links reach."""
    content = F.sha2(F.coalesce(docs[text], F.lit("")).cast("binary"), 256)
    plain = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"), content.alias("content"))
    rows = written(plain.mapInArrow(
        _documents(words, percent), "doc_id long, content string, key binary, n long, probe array<long>"), "overlap-sets")
    kinds = rows.where("n > 0").groupBy("key").agg(
        F.min("content").alias("content"), F.max("n").alias("n"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n_equal"))
    kinds = written(kinds, "overlap-kinds")
    # Sets that share enough of their probe with others, then enough of all.
    named = rows.where("n > 0").select(_key_id(F.col("key")).alias("id"), "probe")
    size = F.col("n")
    least = F.ceil(percent * size / F.lit(100))
    left = kinds.withColumn("id", _key_id(F.col("key"))).join(_shared_counts(named), "id").where(
        F.col("shared") >= F.ceil(least / PROBE_SHARE))
    left = written(left.select("key", "content"), "overlap-left")
    texts = plain.select("content", "text").join(left.hint("merge"), "content").select("key", "text")
    sets = written(texts.mapInArrow(_set_rows(words), "key binary, shingles array<long>").dropDuplicates(["key"]), "overlap-full")
    shared = _shared_counts(sets.select(_key_id(F.col("key")).alias("id"), "shingles"))
    sets = sets.withColumn("id", _key_id(F.col("key"))).join(shared, "id").where(
        F.col("shared") >= F.ceil(percent * F.size("shingles") / F.lit(100))).select("key", "shingles")
    sets = written(sets.withColumn("id", F.monotonically_increasing_id()), "overlap-search")
    groups = written(link_sets(sets.select("id", "shingles"), percent), "overlap-groups")
    lows = kinds.join(sets.select("id", "key").join(groups, "id").drop("id"), "key", "left")
    lowest = lows.where("root is not null").groupBy("root").agg(F.min("low").alias("lowest"))
    reached = written(lows.join(lowest, "root", "left").select(
        "key", "n_equal", F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("component_id")),
        "overlap-reached")
    found = rows.join(reached, "key", "left")
    some = F.col("n") > 0
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(some, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(some, F.lower(F.hex("key"))).alias("set_id"), F.when(some, F.col("n_equal")).alias("n_equal"))
