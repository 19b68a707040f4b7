import hashlib
import zlib

from pyspark.sql import functions as F

from footfall.llm import merkle as M
from tests.llm.helpers import empty_documents, odd_documents, rows_of


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in M.FIELDS))


def tree_of(nodes):
    """The last node, and for every leaf the siblings (left, right) of each level."""
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, i in zip(paths, own):
            run = nodes[i // 16 * 16:i // 16 * 16 + 16]
            path.append((run[:i % 16], run[i % 16 + 1:]))
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        own = [i // 16 for i in own]
    return nodes[0], paths


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    ordered = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in ordered:
        sources[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[s] = tree_of([leaf_of(r) for r in sources[s]])
    root, tops = tree_of([trees[s][0] for s in ordered])
    out = []
    for s, top in zip(ordered, tops):
        for r, path in zip(sources[s], trees[s][1]):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            lowered = None if r["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            node = leaf_of({**r, "text": lowered} if hit else r)
            steps = path + top
            for left, right in steps:
                node = h(*left, node, *right)
            proof = h(*(x for left, right in steps for x in left + right))
            out.append((r["doc_id"], leaf_of(r), trees[s][0], root, proof, node, node == root, hit))
    return sorted(out, key=str)


def check(docs):
    rows = [{f: r[f] for f in M.FIELDS} for r in docs.collect()]
    found = sorted((tuple(r) for r in M.verify_documents(docs).collect()), key=str)
    assert found == brute(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("n_chars", F.length("text"))
    docs = docs.withColumns({"tree": F.lit("x"), "hash": F.lit(1), "path": F.lit(None), "root": F.lit(0)})
    check(docs)


def test_three_levels_hot_source_and_cut_windows(spark, monkeypatch):
    monkeypatch.setattr(M, "SPAN", 16)
    docs = spark.range(900).select(
        (F.col("id") * 7 % 1000).alias("doc_id"),
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("é"), (F.col("id") % 40).cast("string"))).alias("source"),
        F.lit("en").alias("lang"), F.lit(None).cast("long").alias("n_chars"),
        F.concat(F.lit("Text A "), F.col("id").cast("string")).alias("text"))
    check(docs)
    found = M.verify_documents(docs).groupBy("tampered", "verified").count()
    assert {(r["tampered"], r["verified"]) for r in found.collect()} == {(True, False), (False, True)}


def test_sizes_around_full_runs(spark):
    sizes = [1, 2, 15, 16, 17, 255, 256, 257]
    rows = [(i, f"s{n}", None, 0, f"{n} {i}") for n in sizes for i in range(n)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "a", "en", 1, "B")], "doc_id long, source string, lang string, n_chars long, text string")
    check(one)
    row = rows_of(M.verify_documents(one))[0]
    assert row["root"] == row["subroot"] == row["leaf"] and row["proof_sha256"] == h("")
    none = M.verify_documents(empty_documents(spark).withColumn("n_chars", F.lit(1).cast("long")))
    assert none.collect() == [] and "proof_sha256" in none.columns


def test_windows_do_not_hold_a_whole_source(spark):
    nodes = spark.range(5000).select(F.substring(F.col("id").cast("string"), 1, 1).alias("tree"), F.col("id").alias("pos"), F.lit(5000).cast("long").alias("n"),
                                     F.col("id").cast("string").alias("hash"))
    plan = M._with_siblings(nodes)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert exchanges and all("span#" in line for line in exchanges)
