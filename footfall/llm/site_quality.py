"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

1. **Document evidence.** Counts over the whole text (symbols, capitals, repeats, lengths)
   go into a logistic regression, fitted on a bounded sample of labelled rows.
2. **Sites.** Grouped aggregation gives every host and every path of a host its labelled
   documents and, at a discount, what the classifier says of the unlabelled ones. How much
   hosts differ from each other, and paths within hosts, is estimated from the spread of
   their means beyond what sampling explains; that sets how many pseudo-documents of the
   level above a site is mixed with. Sparse sites shrink to their host, sparse hosts to
   the global rate.
3. **Combination.** The log-odds of a document's evidence are shifted by how far the
   posterior of its path departs from the global rate.

Here a host is ``source`` and a path of it is ``lang``. Null hosts and paths are sites of
their own. Null and empty texts have all counts zero. Documents with several label rows count as
good if all say so; null labels are not learned from. Without both classes the score is
the smoothed base rate. Repeated rows are judged one by one.
Other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import bounded_sample, written
from footfall.session import carry_to_workers

carry_to_workers(__name__)

SAMPLE_ROWS = 20_000   # labelled rows that the regression sees
SOFT = 0.1             # what an unlabelled document counts in its site
UNIT = 1_000_000       # soft counts are summed as whole numbers
PRIOR_RANGE = (2.0, 1e6)

FEATURES = ("log_words", "word_length", "symbols", "capitals", "digits", "distinct", "top_word",
            "repeated_lines", "symbol_tails", "bars", "long_words", "neighbours", "end_marks", "line_words")
_SYMBOLS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-()?")
_CAPITALS, _DIGITS = bytes(range(0x41, 0x5B)), bytes(range(0x30, 0x3A))
_TAIL = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F][*#&%$!@^~+=|<>]{2,}")


def measure(text: str | None) -> list[float]:
    """The counts of ``FEATURES`` for one text."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(data)
    without = lambda drop: size - len(data.translate(None, drop))
    counts, lines = Counter(words), [x for x in data.split(b"\n") if x.strip()]
    return [
        float(np.log1p(n)), sum(map(len, words)) / n, without(_SYMBOLS) / size, without(_CAPITALS) / size,
        without(_DIGITS) / size, len(counts) / n, counts.most_common(1)[0][1] / n,
        1 - len(set(lines)) / len(lines), len(_TAIL.findall(data)) / n, data.count(b" | ") / n,
        sum(len(w) > 20 for w in words) / n, sum(map(bytes.__eq__, words, words[1:])) / n,
        (data.count(b".") + data.count(b",")) / n, float(np.log1p(n / len(lines)))]


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [measure(t.as_py()) for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(found, pa.list_(pa.float64()))], ["doc_id", "host", "path", "x"])


def measure_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                      path: str = "lang") -> DataFrame:
    """``doc_id, host, path, x`` with the counts of every document."""
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(
        docs[text].alias("text"), docs[doc_id].alias("doc_id"), docs[host].cast("string").alias("host"),
        docs[path].cast("string").alias("path")).mapInArrow(
        _measured, f"doc_id {kind}, host string, path string, x array<double>")


def fit_regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression on the raw columns of ``x``."""
    mean, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.column_stack([(x - mean) / spread, np.ones(len(x))])
    beta, penalty = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        curve = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
        step = np.linalg.solve(curve, z.T @ (y - p) - penalty * beta)
        beta += step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    weights = beta[:-1] / spread
    return weights, float(beta[-1] - weights @ mean)


def expand(x: np.ndarray) -> np.ndarray:
    """Counts, and their squares for the ones that are bad at either end."""
    return np.column_stack([x, x * x])


def _evidence(weights: np.ndarray, bias: float) -> Column:
    n, total = len(FEATURES), F.lit(float(bias))
    for i in range(n):
        x = F.col("x")[i]
        total = total + x * F.lit(float(weights[i])) + x * x * F.lit(float(weights[n + i]))
    return total


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(between: float, mean: float) -> float:
    """Pseudo-documents of a prior whose means vary by ``between`` around ``mean``."""
    if between <= 0:
        return PRIOR_RANGE[1]
    return float(min(max(mean * (1 - mean) / between - 1, PRIOR_RANGE[0]), PRIOR_RANGE[1]))


def site_posteriors(rows: DataFrame) -> DataFrame:
    """``host, path, host_rate, path_rate, global_rate`` of ``rows (host, path, good, p)``;
    ``good`` is the label or null, ``p`` the classifier's probability."""
    soft = F.when(F.col("good").isNull(), F.round(F.col("p") * UNIT)).cast("long")
    paths = rows.groupBy("host", "path").agg(
        F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"),
        F.count(soft).alias("ns"), F.coalesce(F.sum(soft), F.lit(0)).alias("ks")).select(
        "host", "path", (F.col("n") + SOFT * F.col("ns")).alias("n"),
        (F.col("k") + SOFT * F.col("ks") / UNIT).alias("k"))
    paths = written(paths, "paths")
    hosts = written(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("k").alias("hk")), "hosts")
    total = hosts.agg(F.sum("hn"), F.sum("hk"), F.count(F.lit(1)), F.sum(F.col("hn") * F.col("hn"))).first()
    n, k, count, squares = (float(v or 0) for v in total)
    mean = (k + 1) / (n + 2)

    def between(spread: float, groups: float, size: float, dealt: float) -> float:
        """Variance of the groups' means beyond sampling (the usual moment estimate)."""
        return (spread - (groups - 1) * mean * (1 - mean)) / dealt if dealt > 0 and size > 0 else 0.0

    spread = hosts.where("hn > 0").agg(F.sum(F.col("hn") * F.pow(F.col("hk") / F.col("hn") - mean, 2))).first()[0] or 0.0
    m1 = _strength(between(float(spread), count, n, n - squares / n if n else 0.0), mean)
    hosts = hosts.withColumn("host_rate", (F.col("hk") + m1 * mean) / (F.col("hn") + m1))
    both = paths.join(hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host"))).drop("_host")
    inner = both.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("hk") / F.col("hn"), 2)), F.count(F.lit(1)),
        F.sum(F.col("n") * F.col("n") / F.col("hn")), F.sum("n")).first()
    m2 = _strength(between(float(inner[0] or 0), float(inner[1]) - count + 1, n, float((inner[3] or 0) - (inner[2] or 0))), mean)
    return both.select("host", "path", "host_rate", ((F.col("k") + m2 * F.col("host_rate")) / (F.col("n") + m2)).alias("path_rate"),
                       F.lit(mean).alias("global_rate"))


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", host: str = "source", path: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, score`` (probability of good), ``predicted`` (1 if
    ``score >= 0.5``), ``evidence`` (of the text alone), ``host_rate``, ``path_rate``."""
    rows = written(measure_documents(docs, doc_id, text, host, path), "measured")
    known = labels.select(labels[doc_id].alias("_id"), labels[label].cast("int").alias("good")).where(
        F.col("_id").isNotNull() & F.col("good").isNotNull()).groupBy("_id").agg(F.min("good").alias("good"))
    joined = rows.join(known, rows["doc_id"] == known["_id"], "left").drop("_id")
    counts = known.agg(F.count(F.lit(1)), F.sum("good")).first()
    total, good = counts[0], counts[1] or 0
    ids = bounded_sample(known, F.col("_id"), SAMPLE_ROWS, total)
    # Rows equal in id and measures are one, and an id with very many texts is thinned by them, so the
    # bound holds for rows as well.
    chosen = written(rows.join(ids, rows["doc_id"] == ids["_id"]).select("_id", "x", "good").distinct(), "quality-sample")
    table = bounded_sample(chosen, F.struct("_id", "x"), 2 * SAMPLE_ROWS, chosen.count(), seed=11).select("x", "good").toPandas()
    y = table["good"].to_numpy(float)
    if len(y) and 0 < y.sum() < len(y):
        weights, bias = fit_regression(expand(np.array(table["x"].tolist())), y)
    else:
        weights, bias = np.zeros(2 * len(FEATURES)), float(np.log((good + 0.5) / (total - good + 0.5)))
    evidence = F.least(F.lit(30.0), F.greatest(F.lit(-30.0), _evidence(weights, bias)))
    judged = joined.withColumn("evidence", 1 / (1 + F.exp(-evidence)))
    sites = site_posteriors(judged.select("host", "path", "good", F.col("evidence").alias("p"))).withColumnsRenamed(
        {"host": "_host", "path": "_path"})
    plain = rows.withColumn("evidence", 1 / (1 + F.exp(-evidence)))
    met = plain.join(sites, plain["host"].eqNullSafe(sites["_host"]) & plain["path"].eqNullSafe(sites["_path"]))
    odds = _logit(F.col("evidence")) + _logit(F.col("path_rate")) - _logit(F.col("global_rate"))
    score = 1 / (1 + F.exp(-odds))
    return met.select("doc_id", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"),
                      "evidence", "host_rate", "path_rate")
