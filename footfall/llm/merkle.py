"""A Merkle manifest of a dataset, by lag and lead windows.

**Leaves.** A row's leaf is the SHA-256 of its fields, each as ``-`` if null and else as
byte count, ``:`` and value. The leaves of a source ascend by id (null first, equal ids by
leaf). Digests are lowercase hex text wherever they are hashed again.

**Levels.** Every 16 consecutive nodes of a source make a run; columns at fixed offsets
1 to 15 behind (``lag``) and ahead (``lead``), masked by a node's slot in its run and the
run's length, are its siblings; the first child of a run hashes the run to its parent. Levels
follow until one node, the subroot, is left; a single leaf is its own subroot. The subroots,
ordered by source, are the leaves of one more such tree, whose last node is the root.

**Proofs** run down the levels: a node's path is its siblings and then its parent's path, one
join for each level, each a sixteenth of the one below. Folding a leaf with its path gives
the root again, or does not if the row has changed.

Positions come from a range partitioning by (source, id): a row's place within its task plus
the rows of the tasks before it. Windows are cut at multiples of ``SPAN`` positions, which runs
never cross, so a source that holds most rows is spread like any other. The driver receives
two counts and the root.

Null ids and sources are values like others; a null id is never tampered with. Empty and very
long texts are hashed whole. Repeated rows are leaves of their own; swapping them changes
nothing. An empty table gives no rows. Columns other than the named fields are not read
and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import ascii_lower, written

ARITY = 16
SPAN = 128  # positions of one window; a multiple of ARITY
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one behind the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_hash(fields: list[Column]) -> Column:
    """Each field as ``-`` if null, else byte count, ``:``, value."""
    texts = [f.cast("string") for f in fields]
    return digest(*(F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts))


def _numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows (tree, ...)`` with ``pos``, the place in its tree by ``order``, and ``n``, the
    tree's size. ``order`` begins with the tree."""
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "at", F.monotonically_increasing_id()), "merkle-order")
    task = F.shiftright("at", 33).alias("task")
    counts = placed.groupBy("tree", task).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "tree", "task", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("rows").over(whole).alias("n"))
    return written(placed.withColumn("task", task).join(counts, ["tree", "task"]).withColumn(
        "pos", F.col("at") + F.col("shift")).drop("at", "task", "shift"), "merkle-nodes")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """``nodes (tree, pos, n, hash)`` with ``slot`` and the digests of the run's others before
    (``left``) and behind (``right``), joined."""
    near = Window.partitionBy("tree", "span").orderBy("pos")
    slot = (F.col("pos") % ARITY).cast("int")
    run = F.least(F.lit(ARITY), F.col("n") - F.col("pos") + slot)
    before = [F.when(slot >= k, F.lag("hash", k).over(near)) for k in range(ARITY - 1, 0, -1)]
    behind = [F.when(slot + k < run, F.lead("hash", k).over(near)) for k in range(1, ARITY)]
    spread = nodes.withColumn("span", F.floor(F.col("pos") / SPAN))
    return spread.withColumns({
        "slot": slot,
        "left": F.concat_ws("", *before),
        "right": F.concat_ws("", *behind),
    }).drop("span")


def _up(column: str) -> Column:
    return F.floor(F.col(column) / ARITY)


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """``nodes (tree, pos, n, hash)`` and the levels above, down to one node a tree."""
    found, widest = [nodes.select("tree", "pos", "n", "hash")], nodes.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        first = _with_siblings(found[-1].where("n > 1")).where("slot = 0")
        found.append(written(first.select(
            "tree", _up("pos").alias("pos"), F.ceil(F.col("n") / ARITY).alias("n"),
            digest(F.col("hash"), F.col("right")).alias("hash")), "merkle-level"))
        widest = -(-widest // ARITY)
    return found


def _ends(levels: list[DataFrame]) -> DataFrame:
    """``tree, subroot``: the one node that is left of each tree."""
    ends = [level.where("n = 1").select("tree", F.col("hash").alias("subroot")) for level in levels]
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    return found


def _add(own: Column, above: Column) -> Column:
    return F.concat(F.array(own), above)


def _paths(levels: list[DataFrame], tops: DataFrame, least: int) -> DataFrame:
    """``tree, pos, path, *carried`` for the nodes of level ``least``: the siblings on the way to
    the end of the tree, and then what ``tops (tree, n, path, *carried)`` gives for the tree.
    ``least`` may be one beyond the levels of all trees."""
    carried = [c for c in tops.columns if c not in ("n", "path")]
    found = None
    for level in range(max(len(levels) - 1, least), least - 1, -1):
        size = F.ceil(F.col("n") / F.lit(ARITY ** level))
        ended = tops.where(size == 1).select(F.lit(0).cast("long").alias("pos"), "path", *carried)
        if found is None:
            found = ended
            continue
        own = _with_siblings(levels[level].where("n > 1")).withColumn("above", _up("pos"))
        parents = found.withColumnRenamed("pos", "above")
        found = ended.unionByName(own.join(parents, ["tree", "above"]).select(
            "pos", _add(F.struct("left", "right"), F.col("path")).alias("path"), *carried))
        found = written(found, "merkle-paths")
    return found


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", source: str = "source",
             tampered: Column | None = None, altered: dict[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, leaf, subroot, root, path``, and
    ``folded_root``, the root that the row gives with its siblings now.

    ``altered`` gives columns as found now in the rows where ``tampered`` is true; without
    it all rows are as they were."""
    now = [(altered or {}).get(f, docs[f]) for f in fields]
    hit = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    tree = F.coalesce(F.concat(F.lit("1"), docs[source].cast("string")), F.lit("0"))
    leaves = written(docs.select(
        tree.alias("tree"), docs[doc_id].alias("doc_id"), leaf_hash([docs[f] for f in fields]).alias("hash"),
        F.when(hit, leaf_hash(now)).alias("found")), "merkle-leaves")
    nodes = _numbered(leaves, [F.col("tree"), F.col("doc_id").asc_nulls_first(), F.col("hash")])
    levels = _levels(nodes)
    # The subroots are the leaves of one tree above all sources.
    ends = _ends(levels).select(F.lit("all").alias("tree"), F.col("tree").alias("source"), F.col("subroot").alias("hash"))
    sources = _numbered(ends, [F.col("tree"), F.col("source")])
    upper = _levels(sources)
    root = _ends(upper).first()
    start = sources.select("tree", "n").distinct().withColumn(
        "path", F.array().cast("array<struct<left:string,right:string>>"))
    above = _paths(upper, start, 0)
    tops = sources.drop("n").join(above, ["tree", "pos"]).select(
        F.col("source").alias("tree"), F.col("hash").alias("subroot"), "path")
    sizes = nodes.groupBy("tree").agg(F.max("n").alias("n"))
    tops = written(tops.join(sizes, "tree"), "merkle-tops")
    parents = _paths(levels, tops, 1).withColumnRenamed("pos", "above")
    rows = _with_siblings(nodes).withColumn("above", _up("pos")).join(parents, ["tree", "above"])
    path = F.when(F.col("n") == 1, F.col("path")).otherwise(_add(F.struct("left", "right"), F.col("path")))
    rows = rows.select("doc_id", F.col("hash").alias("leaf"), "subroot",
                       F.lit(root["subroot"] if root else None).cast("string").alias("root"), path.alias("path"), "found")
    folded = F.aggregate("path", F.coalesce("found", "leaf"), lambda node, step: digest(step["left"], node, step["right"]))
    return rows.withColumn("folded_root", folded).withColumn("tampered", F.col("found").isNotNull()).drop("found")


def verify_documents(docs: DataFrame) -> DataFrame:
    """The manifest of documents, held against rows of which every fifth (by the checksum of its
    id) has its letters A-Z lower-cased: ``doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified, tampered``."""
    tampered = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    found = manifest(docs, tampered=tampered, altered={"text": ascii_lower(docs["text"])})
    proof = F.concat_ws("", F.transform("path", lambda step: F.concat(step["left"], step["right"])))
    return found.select("doc_id", "leaf", "subroot", "root", digest(proof).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"), "tampered")
