"""URL filter: given host and path rules, then association rules mined from labels.

Given rules decide first (the longest that fits). Their verdicts on the pages are
the labels from which Spark's FP-growth learns what blocked urls have in common:
baskets hold a url's tokens and its label, and frequent baskets give rules
``tokens -> block`` or ``tokens -> allow``. Rules below the confidence and support
thresholds are pruned, as are rules that a shorter one of no less confidence covers.
The rest are an inverted index from token to rules: a url reads the entries of its own
tokens, and a candidate fires if all its tokens are there. The best fired rule (by
confidence, then support, then number of tokens) decides; without one a url is allowed.

All work is DataFrame expressions; pages are never shuffled. Only the baskets of a
bounded sample of labelled urls are. Null urls and urls without ``://`` have an empty
host and path and no tokens, so they are allowed. Every row is judged by itself.
Without labels nothing is mined.

Repeated pages are judged alike, very long urls by all their tokens; columns
other than the id and the url may have any name. An empty table gives no rows.

Three bounds can keep a rule from being mined: a basket takes ``BASKET_TOKENS`` tokens, so a combination of
tokens that each tell nothing is not found on urls with more frequent tokens than that; the
5,000 most frequent tokens are mined; and ``max_rules`` rules are kept, the most confident first.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import ascii_lower, bounded_sample

# Verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: The given rules and the mined index are literals of the plan, so their number is bounded.
MAX_GIVEN_RULES = 1_000
MAX_MINED_RULES = 500
SAMPLE_URLS = 100_000      # labelled urls that FP-growth sees
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
BASKET_TOKENS = 10         # tokens of a url in a basket: those closest tied to a label

LABEL = "label="


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    """Words of host and path; numbers are one token of their kind."""
    run = F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda text: F.regexp_extract_all(ascii_lower(text), run, F.lit(0))
    plain = lambda kind: lambda w: F.concat(F.lit(kind), F.when(w.rlike("^[0-9]+$"), F.lit("#")).otherwise(w))
    return F.array_distinct(F.concat(F.transform(words(host), plain("host:")), F.transform(words(path), plain("path:"))))


def given_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as ``struct(size, rule, verdict)``; null without one."""
    if len(rules) > MAX_GIVEN_RULES:
        raise ValueError(f"{len(rules)} given rules; at most {MAX_GIVEN_RULES} fit into a plan")
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(len(h + p)).alias("size"), F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for verdict, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


@dataclass(frozen=True)
class Mined:
    """An association rule: these tokens, then this verdict."""

    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def mine_rules(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
               sample_urls: int = SAMPLE_URLS, max_rules: int = MAX_MINED_RULES) -> list[Mined]:
    """Mines ``labelled (url, tokens, verdict)``. A basket takes the tokens of a url that
    tell most about its label, so that long urls cannot blow up the itemsets."""
    total = labelled.count()
    if not total:
        return []
    sample = bounded_sample(labelled, F.col("url"), sample_urls, total)
    sample = sample.select(F.col("tokens"), F.col("verdict")).where(F.size("tokens") > 0)
    counts = (sample.select(F.explode("tokens").alias("token"), "verdict").groupBy("token")
              .agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked")))
    seen = min(total, sample_urls)
    frequent = counts.where(F.col("n") >= max(2, int(min_support * seen)))
    base = sample.agg(F.avg((F.col("verdict") == "block").cast("double"))).first()[0]
    if base is None:
        return []
    # At most 1 / min_support x tokens of a url pass the support threshold.
    lift = {r["token"]: abs(r["blocked"] / r["n"] - base) for r in
            frequent.orderBy(F.desc("n"), "token").limit(5_000).collect()}
    ranked = F.array_sort(F.transform(
        F.filter(F.transform("tokens", lambda t: F.struct(_lookup(lift)[t].alias("lift"), t.alias("token"))),
                 lambda x: x["lift"].isNotNull()),
        lambda x: F.struct((-x["lift"]).alias("order"), x["token"].alias("token"))))
    basket = F.concat(F.transform(F.slice(ranked, 1, BASKET_TOKENS), lambda x: x["token"]),
                      F.array(F.concat(F.lit(LABEL), F.col("verdict"))))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(
        sample.select(basket.alias("items")))
    rules = model.associationRules.where(
        (F.size("consequent") == 1) & F.col("consequent")[0].startswith(LABEL)
        & ~F.exists("antecedent", lambda t: t.startswith(LABEL)))
    best = rules.select(
        F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], len(LABEL) + 1, 99).alias("verdict"),
        F.round("confidence", 9).alias("confidence"), F.round("support", 9).alias("support"))
    top = best.orderBy(F.desc("confidence"), F.desc("support"), F.size("tokens"), F.col("tokens").cast("string")).limit(
        20 * max_rules).collect()
    return prune([Mined(tuple(r["tokens"]), r["verdict"], r["confidence"], r["support"]) for r in top])[:max_rules]


def prune(rules: list[Mined]) -> list[Mined]:
    """Drops a rule if a part of its tokens gives the same verdict no less confidently."""
    kept: list[Mined] = []
    for rule in sorted(rules, key=lambda r: (len(r.tokens), -r.confidence, -r.support, r.tokens)):
        if not any(k.verdict == rule.verdict and k.confidence >= rule.confidence
                   and set(k.tokens) <= set(rule.tokens) for k in kept):
            kept.append(rule)
    return sorted(kept, key=lambda r: (-r.confidence, -r.support, len(r.tokens), r.tokens))


def _lookup(values: dict[str, float]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "map<string,double>")


_ENTRY = "struct<confidence:double,support:double,size:int,verdict:string,tokens:array<string>>"


def fired_rule(tokens: Column, rules: list[Mined]) -> Column:
    """The best mined rule for these tokens, by the inverted index; null without one.

    A rule is filed under one token only, the one that the fewest rules share, so a
    url meets each candidate once."""
    shared: dict[str, int] = {}
    for rule in rules:
        for token in rule.tokens:
            shared[token] = shared.get(token, 0) + 1
    index: dict[str, list[dict]] = {}
    for rule in rules:
        filed = min(rule.tokens, key=lambda t: (shared[t], t))
        index.setdefault(filed, []).append({
            "confidence": rule.confidence, "support": rule.support, "size": len(rule.tokens),
            "verdict": rule.verdict, "tokens": list(rule.tokens)})
    table = F.from_json(F.lit(json.dumps(index)), f"map<string,array<{_ENTRY}>>")
    candidates = F.flatten(F.filter(F.transform(tokens, lambda t: table[t]), lambda c: c.isNotNull()))
    return F.array_max(F.filter(candidates, lambda r: F.size(F.array_except(r["tokens"], tokens)) == 0))


def filter_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES,
                mined: list[Mined] | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, mined_rule, confidence``.

    ``mined`` takes association rules from an earlier run; by default they are mined here."""
    plain = pages.select(pages[page_id].alias("page_id"), pages[url].cast("string").alias("url"))
    split = plain.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    judged = split.withColumn("given", given_rule(F.col("host"), F.col("path"), rules))
    tokens = url_tokens(F.col("host"), F.col("path"))
    if mined is None:
        mined = mine_rules(judged.where(F.col("given").isNotNull()).select(
            "url", tokens.alias("tokens"), F.col("given.verdict").alias("verdict")))
    judged = judged.withColumn("tokens", tokens).withColumn(
        "fired", F.when(F.col("given").isNull(), fired_rule(F.col("tokens"), mined)))
    return judged.select(
        "page_id", "host", "path", F.col("given.rule").alias("rule"),
        F.coalesce(F.col("given.verdict"), F.col("fired.verdict"), F.lit("allow")).alias("verdict"),
        F.array_join("fired.tokens", " ").alias("mined_rule"), F.col("fired.confidence").alias("confidence"))
