"""Language identification by error-correcting output codes.

* **Features.** Byte n-grams (1 to 4 bytes) of the lower-cased letters of a text, words set
  apart by spaces, hashed into ``DIMS`` places; a text counts by the shares of its n-grams,
  so long texts do not outweigh short ones.
* **Codewords.** Every language gets a codeword: for few languages all the ways to split
  them into two groups, for many a random code chosen for its smallest distance.
* **Bits.** One binary classifier per bit, a log-odds weight for each place, learned from
  n-gram sums that Spark aggregates over *all* labelled rows (a table of at most
  languages x ``DIMS`` numbers). A bit's reliability is measured on the training rows.
* **Decoding.** Each bit gives a margin; a language costs the logistic loss of the margins
  against its codeword, weighted by reliability. The nearest codeword wins. ``score`` is
  its share after a softmax over the costs; below ``AMBIGUOUS`` the row is flagged.

Rows with a null ``lang`` are not learned from. A text that is null or has no letter is
``und`` with score 0 and ambiguous, as is any text where nothing was learned. Equal costs
go to the language that sorts first. Each row is judged by its whole text alone.
Repeated rows are judged one by one; other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import bounded_sample, written
from footfall.session import carry_to_workers

carry_to_workers(__name__)

DIMS = 1 << 15
GRAMS = (1, 2, 3, 4)
MAX_EXHAUSTIVE = 5      # languages up to which all splits are used as bits
RANDOM_TRIES = 200
UNIT = 1_000_000        # shares are summed as whole numbers, so the sums do not depend on order
AMBIGUOUS = 0.6
SHARPNESS = 1.0         # scale of the mean log-odds of a text's n-grams
PIECE = 1 << 16         # bytes of a text that are turned into n-grams at a time
_NO_LETTER = re.compile(r"[\W\d_]+")


def places(data: bytes) -> Iterator[np.ndarray]:
    """The places of all n-grams of ``data``, piece by piece."""
    for start in range(0, len(data), PIECE):
        piece = np.frombuffer(data[start:start + PIECE + max(GRAMS) - 1], np.uint8).astype(np.uint64)
        own = min(PIECE, len(data) - start)
        code = np.zeros(len(piece), np.uint64)
        for n in range(1, max(GRAMS) + 1):
            stop = len(piece) - n + 1
            if stop <= 0:
                break
            code = (code[:stop] << np.uint64(8)) | piece[n - 1:]
            if n in GRAMS:
                mixed = (code + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
                yield (mixed[:own] >> np.uint64(64 - DIMS.bit_length() + 1)).astype(np.int64)


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters alone, each between two spaces; empty without letters."""
    words = _NO_LETTER.sub(" ", text.lower()).strip() if text else ""
    return f" {words} ".encode("utf-8", "surrogatepass") if any(map(str.isalpha, words)) else b""


def shares(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of a text and their share of its n-grams."""
    total = np.zeros(DIMS, np.int64) if len(data) > PIECE else None
    if total is None:
        place, count = np.unique(np.concatenate(list(places(data))), return_counts=True)
    else:
        for p in places(data):
            total += np.bincount(p, minlength=DIMS)
        place = np.flatnonzero(total)
        count = total[place]
    return place, count / count.sum()


@dataclass(frozen=True)
class Model:
    """``code`` (languages x bits, -1 or 1), ``weights`` (DIMS x bits), ``bias``, ``trust``."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def margins(self, data: bytes) -> np.ndarray:
        place, share = shares(data)
        return share.astype(np.float32) @ self.weights[place] + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        data = letters(text)
        if not data or not self.languages:
            return "und", 0.0, True
        cost = self.costs(self.margins(data))
        best = int(np.argmin(cost))
        share = float(1 / np.exp(cost[best] - cost).sum())
        return self.languages[best], share, share < AMBIGUOUS

    def costs(self, margins: np.ndarray) -> np.ndarray:
        """Loss of every codeword, weighted by how far each bit can be trusted."""
        return (np.logaddexp(0, -self.code * margins) * self.trust).sum(1)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """A row of -1 and 1 for each of ``n`` languages."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= MAX_EXHAUSTIVE:
        splits = [set(c) for k in range(n) for c in combinations(range(1, n), k) if len(c) < n - 1]
        return np.array([[1 if i == 0 or i in s else -1 for s in splits] for i in range(n)], float)
    rng, best, distance = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(RANDOM_TRIES):
        code = rng.choice([-1.0, 1.0], (n, bits))
        if (np.abs(code.sum(0)) == n).any():
            continue
        least = min(int((code[i] != code[j]).sum()) for i, j in combinations(range(n), 2))
        if least > distance:
            best, distance = code, least
    if best is None:
        raise ValueError("no code found")
    return best


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of shares by language over a task's rows; ``place`` -1 counts the rows."""
    held: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            data = letters(text.as_py())
            if data:
                place, share = shares(data)
                total = held.setdefault(lang, np.zeros(DIMS, np.int64))
                total[place] += np.rint(share * UNIT).astype(np.int64)
                rows[lang] = rows.get(lang, 0) + 1
    for lang, total in held.items():
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * (len(place) + 1)), pa.array(np.append(place, -1)),
             pa.array(np.append(total[place], rows[lang]))], ["lang", "place", "total"])


def _reliability(model: Model):
    """For each bit, how many training rows of each side it gets right."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = {lang: i for i, lang in enumerate(model.languages)}
        right, seen = np.zeros(model.code.shape[1], np.int64), 0
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                data = letters(text.as_py())
                if data and lang in where:
                    right += np.sign(model.margins(data)) == model.code[where[lang]]
                    seen += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(right))), pa.array(right), pa.array([seen] * len(right), pa.int64())],
            ["bit", "right", "seen"])
    return run


TRUST_ROWS = 20_000  # labelled rows on which the bits' reliability is measured
MAX_LANGUAGES = 500  # the model's size follows from it


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learns from all rows of ``labelled`` whose language is not null."""
    rows = labelled.select(labelled[text].alias("text"), labelled[lang].cast("string").alias("lang")).where(
        F.col("lang").isNotNull())
    sums = written(rows.mapInArrow(_sums, "lang string, place long, total long").groupBy("lang", "place").agg(
        F.sum("total").alias("total")), "ngrams")
    counts = {r["lang"]: r["total"] for r in
              sums.where("place = -1").orderBy(F.desc("total"), "lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(counts)
    if not languages:
        return Model([], np.ones((0, 1)), np.zeros((DIMS, 1), np.float32), np.zeros(1), np.ones(1))
    table = np.zeros((len(languages), DIMS))
    where = {name: i for i, name in enumerate(languages)}
    found = sums.where("place >= 0").toPandas()  # at most languages x DIMS rows
    table[found["lang"].map(where), found["place"]] = found["total"] / UNIT
    # A language counts the same however many rows it has.
    table /= np.array([counts[name] for name in languages])[:, None]
    code = codewords(len(languages))
    weights, floor = np.zeros((DIMS, code.shape[1]), np.float32), 1e-7
    for bit in range(code.shape[1]):
        yes = table[code[:, bit] > 0].mean(0) if (code[:, bit] > 0).any() else np.zeros(DIMS)
        no = table[code[:, bit] < 0].mean(0) if (code[:, bit] < 0).any() else np.zeros(DIMS)
        weights[:, bit] = np.log(yes + floor) - np.log(no + floor)
    model = Model(languages, code, weights * np.float32(SHARPNESS), np.zeros(code.shape[1]), np.ones(code.shape[1]))
    total = int(sum(counts.values()))
    checked = bounded_sample(rows, F.col("text"), TRUST_ROWS, total).mapInArrow(
        _reliability(model), "bit long, right long, seen long").groupBy("bit").agg(
        F.sum("right").alias("right"), F.sum("seen").alias("seen")).toPandas()
    trust = np.ones(code.shape[1])
    for bit, right, seen in checked[["bit", "right", "seen"]].itertuples(index=False):
        accuracy = (right + 1) / (seen + 2)
        trust[bit] = max(0.0, 0.5 * np.log(accuracy / (1 - accuracy)))
    # On average a bit weighs one; a bit no better than chance is left out.
    trust = trust / trust.mean() if trust.sum() else np.ones_like(trust)
    return Model(languages, code, model.weights, model.bias, trust)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The model, DIMS x bits numbers, travels with the function.
        for batch in batches:
            rows = [model.predict(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()),
                 pa.array(columns[2], pa.bool_())], ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(docs[doc_id], docs[text]).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
