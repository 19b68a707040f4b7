"""Toxicity: a learned lexicon, misspellings by Levenshtein automata, and context.

**Lexicon.** From a bounded sample of labelled rows Spark counts, for every word, the
different neighbourhoods (word before, word after) in which it stands in toxic and in
other texts. Counting neighbourhoods instead of rows keeps a group of copies from voting
many times. A word, or a word start that many inflected forms share, becomes an entry if
a likelihood-ratio test finds it tied to toxic texts beyond what chance would give among
all words tested.

**Misspellings.** The entries form a trie. A word of a text that is no entry is turned
into a Levenshtein automaton, whose states (rows of edit distances) are advanced along
the trie's edges; branches without a way to acceptance are cut. A test of the intact
half of an entry keeps nearly all words from reaching the automaton. A word start stands for
whole words, so the ones it was learned from become entries of the trie beside it.

**Context.** A find inside quotation marks, or near words that report speech, counts less;
one near words that address a reader counts more.

**Score.** A logistic model of a few sums of evidence, fitted on the sample and pulled
towards default weights where the sample says little.

Null and empty texts have no finds; their score is that of a text without any. Rows are
judged one by one, so ties and repeats do not matter. Documents with several label rows
count as toxic if one says so; null labels are not learned from. Without toxic or without
clean rows to learn from the lexicon is empty and the score is the smoothed base rate.
Other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import bounded_sample, written
from footfall.session import carry_to_workers

carry_to_workers(__name__)

TOXIC_ROWS, CLEAN_ROWS = 4_000, 8_000  # labelled rows of the sample, at most (on average)
MAX_ENTRIES = 2_000
CANDIDATES = 5_000
STARTS = (4, 5, 6, 7)     # lengths of word starts that may become entries
FALSE_ENTRIES = 0.01      # expected number of entries by chance
MAX_EDITS = 1
MIN_FUZZY = 5             # letters of an entry from which misspellings are sought
WINDOW = 6                # words before and after a find that make its context

# Words that report speech, and words that address somebody.
REPORTS = frozenset("said says called quote quoted quotes word term slur meaning insult insults wrote"
                    " sagte wort zitat dijo palabra cita dit mot citation".split())
ADDRESSES = frozenset("you your youre du dein ihr tu tus vous toi eres".split())
QUOTES = frozenset("\"“”„«»")
REPORTED, ADDRESSED = 0.3, 1.25  # factors on the evidence of a find

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Entry:
    """A lexicon entry: a word, or with ``start`` the beginning of words."""

    text: str
    start: bool
    weight: float
    fuzzy: float = 0.0  # evidence of a misspelled form


# ---------------------------------------------------------------- automaton

class Node:
    __slots__ = ("children", "entry")

    def __init__(self) -> None:
        self.children: dict[str, Node] = {}
        self.entry: Entry | None = None


def build_trie(entries: list[Entry]) -> Node:
    root = Node()
    for entry in entries:
        node = root
        for letter in entry.text:
            node = node.children.setdefault(letter, Node())
        node.entry = entry
    return root


def automaton_step(row: tuple[int, ...], word: str, letter: str, most: int) -> tuple[int, ...]:
    """The state of the Levenshtein automaton of ``word`` after one more ``letter``: entry i
    is the distance of what was read to the first i letters, cut at ``most`` + 1."""
    out = [min(row[0] + 1, most + 1)]
    for i, own in enumerate(word, 1):
        out.append(min(row[i - 1] + (own != letter), row[i] + 1, out[-1] + 1, most + 1))
    return tuple(out)


def fuzzy_find(word: str, root: Node, most: int) -> list[tuple[int, Entry]]:
    """(distance, entry) of all whole-word entries within ``most`` edits of ``word``."""
    found = []
    todo = [(root, tuple(min(i, most + 1) for i in range(len(word) + 1)))]
    while todo:
        node, row = todo.pop()
        if node.entry is not None and not node.entry.start and row[-1] <= most:
            found.append((row[-1], node.entry))
        for letter, child in node.children.items():
            state = automaton_step(row, word, letter, most)
            if min(state) <= most:
                todo.append((child, state))
    return sorted(found, key=lambda f: (f[0], -f[1].weight, f[1].text))


@dataclass
class Lexicon:
    entries: list[Entry]
    edits: int = MAX_EDITS
    words: dict[str, Entry] = field(init=False)
    starts: dict[int, dict[str, Entry]] = field(init=False)

    def __post_init__(self) -> None:
        self.words = {e.text: e for e in self.entries if not e.start}
        self.starts = {}
        for e in self.entries:
            if e.start:
                self.starts.setdefault(len(e.text), {})[e.text] = e
        sought = [e for e in self.entries if not e.start and len(e.text) >= MIN_FUZZY]
        self.trie = build_trie(sought)
        # A word within k edits keeps one of k + 1 pieces of the entry; with one edit that
        # is its first half at the start or its second half at the end.
        self.heads: dict[int, dict[int, set[str]]] = {}
        self.tails: dict[int, dict[int, set[str]]] = {}
        self.pieces: dict[int, set[str]] = {}
        for e in sought:
            half = len(e.text) // 2
            for n in range(len(e.text) - self.edits, len(e.text) + self.edits + 1):
                self.heads.setdefault(n, {}).setdefault(half, set()).add(e.text[:half])
                tail = len(e.text) - half
                self.tails.setdefault(n, {}).setdefault(tail, set()).add(e.text[half:])
                if self.edits > 1:
                    size = len(e.text) // (self.edits + 1)
                    cuts = [e.text[i * size:(i + 1) * size] for i in range(self.edits + 1)]
                    self.pieces.setdefault(n, set()).update(c for c in cuts if c)
        self.seen: dict[str, tuple[int, Entry] | None] = {}

    def look_up(self, word: str) -> tuple[int, Entry] | None:
        """(distance, entry) of the best entry for a word; answers are remembered."""
        try:
            return self.seen[word]
        except KeyError:
            if len(self.seen) > 500_000:
                self.seen.clear()
            self.seen[word] = found = self._look_up(word)
            return found

    def _look_up(self, word: str) -> tuple[int, Entry] | None:
        entry = self.words.get(word)
        if entry is not None:
            return 0, entry
        for size, starts in self.starts.items():
            if word[:size] in starts:
                return 0, starts[word[:size]]
        if self._near(word):
            found = fuzzy_find(word, self.trie, self.edits)
            if found:
                return found[0]
        return None

    def _near(self, word: str) -> bool:
        n = len(word)
        if self.edits > 1:
            return any(p in word for p in self.pieces.get(n, ()))
        return (any(word[:size] in heads for size, heads in self.heads.get(n, {}).items())
                or any(word[n - size:] in tails for size, tails in self.tails.get(n, {}).items() if size <= n))


def evidence(text: str | None, lexicon: Lexicon) -> tuple[float, float, int, dict[str, bool]]:
    """Evidence of exact and of misspelled finds, their number, and the entries found
    (true: in misspelled form only)."""
    if not text:
        return 0.0, 0.0, 0, {}
    lowered = text.lower()
    look_up = lexicon.look_up
    hits = {w: f for w in set(_WORD.findall(lowered)) if (f := look_up(w)) is not None}
    if not hits:
        return 0.0, 0.0, 0, {}
    spans = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(lowered)]
    exact = fuzzy = 0.0
    count, entries = 0, {}
    for i, (start, end, word) in enumerate(spans):
        if word not in hits:
            continue
        distance, entry = hits[word]
        first, last = spans[max(0, i - WINDOW)], spans[min(len(spans) - 1, i + WINDOW)]
        near = {w for _, _, w in spans[max(0, i - WINDOW):i + WINDOW + 1]}
        before, behind = lowered[first[0]:start], lowered[end:last[1]]
        quoted = any(c in QUOTES for c in before) and any(c in QUOTES for c in behind)
        factor = REPORTED if quoted or near & REPORTS else ADDRESSED if near & ADDRESSES else 1.0
        count += 1
        if distance:
            fuzzy += factor * entry.fuzzy
            entries.setdefault(entry.text, True)
        else:
            exact += factor * entry.weight
            entries[entry.text] = False
    return exact, fuzzy, count, entries


# ---------------------------------------------------------------- learning

@dataclass(frozen=True)
class Model:
    entries: tuple[Entry, ...]
    bias: float
    exact: float
    fuzzy: float
    edits: int = MAX_EDITS

    def score(self, text: str | None, lexicon: Lexicon) -> tuple[float, int]:
        exact, fuzzy, count, _ = evidence(text, lexicon)
        x = self.bias + self.exact * math.log1p(exact) + self.fuzzy * math.log1p(fuzzy)
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x)))), count


def _neighbourhoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, hash of its first neighbourhood, toxic) once per text and word."""
    for batch in batches:
        out: list[list] = [[], [], []]
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            words = _WORD.findall(text.as_py().lower()) if text.is_valid else []
            first: dict[str, int] = {}
            for i, word in enumerate(words):
                first.setdefault(word, i)
            for word, i in first.items():
                around = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
                out[0].append(word)
                out[1].append(xxhash.xxh32_intdigest(around.encode("utf-8", "surrogatepass")))
            out[2].extend([toxic] * len(first))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32())],
            ["word", "around", "toxic"])


def tie(t: float, c: float, rate: float) -> float:
    """How far ``t`` toxic of ``t + c`` neighbourhoods exceed ``rate``, as a log likelihood ratio."""
    n = t + c
    if not n or t <= n * rate:
        return 0.0
    return t * math.log(t / (n * rate)) + (c * math.log(c / (n * (1 - rate))) if c else 0.0)


def choose_entries(rows: list[tuple[str, bool, int, int]], toxic: int, clean: int, least: float,
                   most: int = MAX_ENTRIES) -> list[Entry]:
    """Entries out of candidates ``(text, start, t, c)``, strongest first. What a chosen
    entry explains is taken off the shorter starts that contain it."""
    rate = toxic / (toxic + clean)
    chosen: list[tuple[str, bool, int, int]] = []
    order = sorted(rows, key=lambda r: (-tie(r[2], r[3], rate), r[1], -len(r[0]), r[0]))
    for text, start, t, c in order:
        if any(text == o or (s and text.startswith(o)) for o, s, _, _ in chosen):
            continue
        if start:
            t -= sum(x for o, _, x, _ in chosen if o.startswith(text))
            c -= sum(x for o, _, _, x in chosen if o.startswith(text))
        if t > 0 and tie(t, max(c, 0), rate) > least:
            chosen.append((text, start, t, max(c, 0)))
        if len(chosen) == most:
            break
    weigh = lambda t, c: math.log((t + 0.5) / (c + 0.5) * (clean / toxic))
    return [Entry(text, start, max(0.1, weigh(t, c))) for text, start, t, c in chosen]


def covered_words(rows: list[tuple[str, bool, int, int]], strongest: dict[str, str],
                  entries: list[Entry]) -> list[Entry]:
    """The whole words of the candidates that a chosen start covers, and of each start the
    strongest one. They weigh what the start does; misspellings of them are sought."""
    starts = {e.text: e for e in entries if e.start}
    words = [r[0] for r in rows if not r[1]] + [w for _, w in sorted(strongest.items())]
    known, found = {e.text for e in entries if not e.start}, []
    for word in dict.fromkeys(words):
        own = next((starts[word[:n]] for n in sorted(STARTS) if word[:n] in starts), None)
        if own is not None and len(word) >= MIN_FUZZY and word not in known:
            found.append(Entry(word, False, own.weight))
    return found


def sample_labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    label: str = "toxic") -> tuple[DataFrame, dict[int, float]]:
    """A bounded sample ``text, toxic`` of both classes, and the share of each that it holds. Ids are
    chosen first, then rows: rows equal in id and text are one, and an id with very many texts is
    thinned by them, so the bound holds for rows whatever repeats."""
    ids = labels.select(labels[doc_id].alias("doc_id"), labels[label].cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in ids.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    parts, share = [], {}
    for toxic, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        total = totals.get(toxic, 0)
        own = ids.where((F.col("toxic") > 0) == bool(toxic)).select("doc_id", F.lit(toxic).alias("toxic"))
        parts.append(bounded_sample(own, F.col("doc_id"), most, total))
        share[toxic] = min(1.0, most / total) if total else 1.0
    chosen = parts[0].unionByName(parts[1])  # TOXIC_ROWS + CLEAN_ROWS ids: bounded, so broadcast
    texts = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    rows = written(texts.join(F.broadcast(chosen), "doc_id").distinct(), "labelled-rows")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    kept = []
    for toxic, most in ((1, TOXIC_ROWS), (0, CLEAN_ROWS)):
        total, bound = totals.get(toxic, 0), 2 * most  # ids with a single text each stay as they are
        kept.append(bounded_sample(rows.where(F.col("toxic") == toxic), F.struct("doc_id", "text"), bound, total, seed=11))
        share[toxic] *= min(1.0, bound / total) if total else 1.0
    return written(kept[0].unionByName(kept[1]).select("text", "toxic"), "labelled"), share


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", edits: int = MAX_EDITS) -> Model:
    """Learns from the rows of ``docs`` that have a label."""
    sample, share = sample_labelled(docs, labels, doc_id, text, label)
    rows = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = rows.get(1, 0), rows.get(0, 0)
    prior = math.log((toxic / share[1] + 0.5) / (clean / share[0] + 0.5))
    if not toxic or not clean:
        return Model((), prior, 0.0, 0.0, edits)
    around = sample.mapInArrow(_neighbourhoods, "word string, around long, toxic int")
    words = written(around.distinct().groupBy("word").agg(
        F.count(F.when(F.col("toxic") == 1, 1)).alias("t"), F.count(F.when(F.col("toxic") == 0, 1)).alias("c")), "words")
    sizes = words.agg(F.count(F.lit(1)), F.sum("t"), F.sum("c")).first()
    if not sizes[0] or not sizes[1] or not sizes[2]:
        return Model((), prior, 0.0, 0.0, edits)
    least = math.log(sizes[0] * (1 + len(STARTS)) / FALSE_ENTRIES)
    rate = sizes[1] / (sizes[1] + sizes[2])
    starts = F.explode(F.array(*[F.substring("word", 1, n) for n in STARTS]))
    begun = words.where(F.length("word") >= min(STARTS)).select(starts.alias("start"), "t", "c", "word").where(
        F.length("start") < F.length("word")).groupBy("start").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"), F.count(F.lit(1)).alias("forms")).where("forms > 1")
    whole = words.select(F.col("word").alias("text"), F.lit(False).alias("start"), "t", "c")
    # A start also takes the word that is no longer than itself.
    begun = begun.join(words.select(F.col("word").alias("start"), F.col("t").alias("t0"), F.col("c").alias("c0")),
                       "start", "left").select(
        F.col("start").alias("text"), F.lit(True).alias("start"),
        (F.col("t") + F.coalesce("t0", F.lit(0))).alias("t"), (F.col("c") + F.coalesce("c0", F.lit(0))).alias("c"))
    n = F.col("t") + F.col("c")
    ratio = F.col("t") * F.log(F.col("t") / (n * rate)) + F.when(
        F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - rate)))).otherwise(0)
    best = whole.unionByName(begun).where((F.col("t") > n * rate) & (F.length("text") >= 3)).withColumn(
        "ratio", ratio).where(F.col("ratio") > least)
    found = [(r["text"], r["start"], r["t"], r["c"]) for r in
             best.orderBy(F.desc("ratio"), "text", "start").limit(CANDIDATES).collect()]
    entries = choose_entries(found, sizes[1], sizes[2], least)
    chosen = [e.text for e in entries if e.start]  # at most MAX_ENTRIES
    if chosen:
        strongest = words.select(
            F.explode(F.array_distinct(F.array(*[F.substring("word", 1, k) for k in STARTS]))).alias("start"), "word", "t", "c").where(
            F.col("start").isin(chosen) & (F.length("word") >= MIN_FUZZY) & (F.col("t") > n * rate)).groupBy("start").agg(
            F.max_by("word", F.struct(ratio.alias("ratio"), "word")).alias("word"))
        entries += covered_words(found, {r["start"]: r["word"] for r in strongest.collect()}, entries)
    return _fit(sample, entries, share, prior, toxic, clean, edits)


_FEATURES = "exact double, fuzzy double, toxic int, misspelled array<string>"


def _features(entries: list[Entry], edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(entries, edits)
        for batch in batches:
            rows = [evidence(t.as_py(), lexicon) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.float64()),
                 batch.column(1), pa.array([[e for e, only in r[3].items() if only] for r in rows], pa.list_(pa.string()))],
                ["exact", "fuzzy", "toxic", "misspelled"])
    return run


def _fit(sample: DataFrame, entries: list[Entry], share: dict[int, float], prior: float,
         toxic: int, clean: int, edits: int) -> Model:
    """Weighs misspelled forms by where they were found, then fits the score."""
    first = sample.mapInArrow(_features(entries, edits), _FEATURES)
    forms = first.select(F.explode("misspelled").alias("entry"), "toxic").groupBy("entry").agg(
        F.count(F.when(F.col("toxic") == 1, 1)).alias("t"), F.count(F.when(F.col("toxic") == 0, 1)).alias("c"))
    counts = {r["entry"]: (r["t"], r["c"]) for r in forms.collect()}  # of the entries, so bounded

    def weighed(e: Entry) -> Entry:
        t, c = counts.get(e.text, (0, 0))
        return Entry(e.text, e.start, e.weight, max(0.0, min(e.weight, math.log((t + 2) / (c + 0.2) * clean / toxic))))

    entries = [weighed(e) for e in entries]
    table = sample.mapInArrow(_features(entries, edits), _FEATURES).select("exact", "fuzzy", "toxic").toPandas()
    x = np.column_stack([np.ones(len(table)), np.log1p(table["exact"]), np.log1p(table["fuzzy"])])
    y = table["toxic"].to_numpy(float)
    weight = np.where(y == 1, 1 / share[1], 1 / share[0])
    weight = weight * len(y) / weight.sum()
    # Penalties pull towards defaults: no find is the base rate, a find speaks for itself.
    center, strength = np.array([min(prior, -1.0), 2.0, 1.5]), np.array([0.01, 0.5, 2.0])
    beta = center.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - strength * (beta - center)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(strength)
        step = np.linalg.solve(curve, gradient)
        beta += step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-10:
            break
    return Model(tuple(entries), round(float(beta[0]), 9), round(max(0.0, float(beta[1])), 9),
                 round(max(0.0, float(beta[2])), 9), edits)


# ---------------------------------------------------------------- use

def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, predicted, finds`` for every row."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(list(model.entries), model.edits)
        for batch in batches:
            rows = [model.score(t.as_py(), lexicon) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.float64()),
                 pa.array([int(r[0] >= 0.5) for r in rows], pa.int32()),
                 pa.array([r[1] for r in rows], pa.int32())], ["doc_id", "score", "predicted", "finds"])

    return docs.select(docs[doc_id], docs[text]).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int, finds int")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows that score below ``threshold``, with all columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(list(model.entries), model.edits)
        for batch in batches:
            stay = [model.score(t.as_py(), lexicon)[0] < threshold for t in batch.column(at)]
            yield batch.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
