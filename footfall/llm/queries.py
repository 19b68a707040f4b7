"""The queries of the corpus operators and, where SQL can express them, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.llm import (
    decontaminate,
    exact_dedup,
    language_id,
    license_scan,
    merkle,
    mixing,
    overlap_join,
    simhash,
    site_quality,
    token_counts,
    toxicity,
    url_rules,
    vector_codes,
)
from footfall.llm.common import LOWER, UPPER, id_remainder, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign_owners(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.where(id_remainder(F.col("doc_id"), 3) != 1))
    return language_id.predict(docs, model).select(
        "doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.group_documents(table(spark, sf_dir, "documents"))


def op8_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    scored = site_quality.score_quality(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(~held_out))
    return scored.withColumn("held_out", held_out)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder(F.col("doc_id"), 5) == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score_documents(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", "finds")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_shares(table(spark, sf_dir, "documents"))


def op11_overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap_join.join_similar(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress_vectors(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_license_scan, op2_exact_dedup, op3_language_id, op4_url_rules, op5_token_counts,
             op6_decontaminate, op7_simhash, op8_site_quality, op9_toxicity, op10_mixing, op11_overlap_join,
             op12_vector_codes, op13_merkle]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": LICENSE_SCAN,
        "op2_exact_dedup": EXACT_DEDUP,
        "op6_decontaminate": DECONTAMINATE,
        "op12_vector_codes": VECTOR_CODES,
        "op13_merkle": MERKLE,
    }


EXACT_DEDUP = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id,
             count(*) OVER (PARTITION BY t) AS group_size
      FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATE = f"""
WITH item_words AS (SELECT item_id, {_WORDS.format("lower(coalesce(text, ''))")} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(5, len(w)) AS k FROM item_words WHERE len(w) > 0),
item_shingles AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
item_sizes AS (SELECT item_id, count(*) AS item_shingles FROM item_shingles GROUP BY 1),
doc_words AS (SELECT doc_id, {_WORDS.format("lower(coalesce(text, ''))")} AS w FROM documents),
doc_shingles AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT d.*, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc_words d, (SELECT DISTINCT k FROM sized) WHERE len(w) >= k))
SELECT doc_id, item_id, count(*) / item_shingles AS containment, count(*) AS shared, item_shingles
FROM doc_shingles JOIN item_shingles USING (k, s) JOIN item_sizes USING (item_id)
GROUP BY doc_id, item_id, item_shingles HAVING count(*) >= ceil(0.8 * item_shingles - 1e-9)
"""

# Words stand between two spaces each, so that neighbouring matches share none.
_BASE = ("under  the  mit  license", "apache  license  version  2", "cc  by  nc")
_BASE_LABELS = ("mit", "apache-2", "cc-by-nc")
# The other templates as patterns: label, kind, wording.
_PATTERNS = (
    ("mit", 1.0, "permission is hereby granted free of charge to any person obtaining a copy of this software"
     " and( associated)? documentation files( the software)? to deal in the software without restriction"),
    ("apache-2", 1.0, "licensed under the apache license version 2 0( the license)? you may not use this file"
     " except in compliance with the license"),
    ("gpl-3", 0.8, "gnu general public license( as published by the free software foundation)?( either)? version 3"),
    ("gpl-2", 0.8, "gnu general public license( as published by the free software foundation)?( either)? version 2"),
    ("lgpl", 0.8, "gnu (lesser|library) general public license"),
    ("agpl-3", 0.8, "gnu affero general public license"),
    ("mpl-2", 0.8, "mozilla public license( version| v)? 2"),
    ("bsd", 0.8, "under the( [^ ]+)? bsd( [^ ]+){0,2} license"),
    ("bsd", 1.0, "redistribution and use in source and binary forms with or without modification are permitted"
     " provided that the following conditions are met"),
    ("isc", 1.0, "permission to use copy modify and( or)? distribute this software for any purpose with or"
     " without fee is hereby granted provided that the above copyright notice and this permission notice"
     " appear in all copies"),
    ("zlib", 1.0, "this software is provided as is without any express or implied warranty in no event will the"
     " authors be held liable for any damages arising from the use of this software"),
    ("cc-by-sa", 0.8, "cc by sa"),
    ("cc-by-nd", 0.8, "cc by nd"),
    ("cc-by", 0.8, "cc by (1|2|3|4)"),
    ("cc0", 0.8, "(cc0|cc zero)"),
    ("unlicense", 1.0, "this is free and unencumbered software released into the public domain"),
)


def _license_sql() -> str:
    place = lambda p: f"strpos(s, ' {p} ')"
    back = lambda p: f"strpos(reverse(s), reverse(' {p} '))"
    before = lambda p: f"len(regexp_extract_all(left(s, {place(p)} - 1), '[^ ]+'))"
    behind = lambda p: f"len(regexp_extract_all(right(s, {back(p)} - 1), '[^ ]+'))"
    count = lambda p: f"(len(s) - len(replace(s, ' {p} ', ''))) / len(' {p} ')"
    firsts = ", ".join(f"CASE WHEN {place(p)} > 0 THEN {before(p)} END" for p in _BASE)
    lasts = ", ".join(
        f"CASE WHEN {place(p)} > 0 THEN n_words - {behind(p)} - {len(p.split())} END" for p in _BASE)
    base = ", ".join(f"CASE WHEN {place(p)} > 0 THEN '{label}' END" for p, label in zip(_BASE, _BASE_LABELS))
    more = ", ".join(f"CASE WHEN regexp_matches(plain, ' {p} ') THEN '{label}' END" for label, _, p in _PATTERNS)
    texts = " OR ".join(f"regexp_matches(plain, ' {p} ')" for _, score, p in _PATTERNS if score == 1.0)
    lowered = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
    joined = "array_to_string(list_sort(list_distinct([{}])), ',')"
    return f"""
WITH words AS (SELECT doc_id, {_WORDS.format(lowered)} AS w FROM documents),
lines AS (SELECT doc_id, len(w) AS n_words, ' ' || array_to_string(w, '  ') || ' ' AS s,
                 ' ' || array_to_string(w, ' ') || ' ' AS plain FROM words)
SELECT doc_id, n_words, CAST({" + ".join(map(count, _BASE))} AS BIGINT) AS n_base,
       list_min([{firsts}]) AS first_word, list_max([{lasts}]) AS last_word,
       {joined.format(base)} AS base_labels, {joined.format(base + ", " + more)} AS labels,
       CASE WHEN {texts} THEN CAST(1 AS DOUBLE) WHEN {joined.format(base + ", " + more)} <> '' THEN CAST(0.8 AS DOUBLE)
            ELSE CAST(0 AS DOUBLE) END AS score
FROM lines
"""


LICENSE_SCAN = _license_sql()


def _leaf_sql(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(
        f"CASE WHEN {f} IS NULL THEN '-' ELSE CAST(octet_length(encode({f})) AS VARCHAR) || ':' || {f} END"
        for f in fields) + ")"


def _merkle_sql(levels: int = 4) -> str:
    """Trees of up to 16^levels leaves, level by level. Source trees first, then one of the subroots."""
    crc = ("4294967295 - list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform("
           "string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: list_reduce("
           "[xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * CAST(3988292384 AS BIGINT))))")
    lowered = f"translate(text, '{UPPER}', '{LOWER}')"
    steps = [f"""
n0 AS MATERIALIZED (
  SELECT doc_id, source, CASE WHEN hit THEN {_leaf_sql(lowered)} ELSE {_leaf_sql("text")} END AS found,
         {_leaf_sql("text")} AS leaf, hit
  FROM (SELECT *, coalesce(({crc}) % 5 = 0, false) AS hit FROM documents)),
a0 AS MATERIALIZED (
  SELECT *, leaf AS h, found AS f, '' AS proof, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM n0 WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf))"""]
    # Each row carries its ancestor's digest h, its own folded value f and the proof so far.
    def climb(new: str, old: str, tree: str) -> str:
        return f"""
{new}n AS MATERIALIZED (SELECT DISTINCT {tree} AS tree, pos, h, n FROM {old}),
{new}r AS MATERIALIZED (
  SELECT tree, pos // 16 AS run, list(h ORDER BY pos) AS hs, any_value(n) AS n FROM {new}n GROUP BY 1, 2),
{new} AS MATERIALIZED (
  SELECT o.* REPLACE (
    CASE WHEN o.n > 1 THEN sha256(array_to_string(r.hs, '')) ELSE o.h END AS h,
    CASE WHEN o.n > 1 THEN sha256(array_to_string(r.hs[:o.pos % 16], '') || o.f || array_to_string(r.hs[o.pos % 16 + 2:], ''))
         ELSE o.f END AS f,
    CASE WHEN o.n > 1 THEN o.proof || array_to_string(r.hs[:o.pos % 16], '') || array_to_string(r.hs[o.pos % 16 + 2:], '')
         ELSE o.proof END AS proof,
    o.pos // 16 AS pos, (o.n + 15) // 16 AS n)
  FROM {old} o JOIN {new}r r ON {tree} IS NOT DISTINCT FROM r.tree AND o.pos // 16 = r.run)"""
    steps += [climb(f"a{i + 1}", f"a{i}", "source") for i in range(levels)]
    steps.append(f"""
roots AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
          FROM (SELECT DISTINCT source FROM a{levels})),
b0 AS MATERIALIZED (SELECT a.* REPLACE (r.pos AS pos, r.n AS n), a.h AS subroot
       FROM a{levels} a JOIN roots r ON a.source IS NOT DISTINCT FROM r.source)""")
    steps += [climb(f"b{i + 1}", f"b{i}", "0") for i in range(levels)]
    return "WITH " + ",".join(steps) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified, hit AS tampered
FROM b{levels}
"""


MERKLE = _merkle_sql()


def _vector_codes_sql(rounds: int = 4) -> str:
    """Exact in doubles: components are below 2^11, sums of their products far below 2^53."""
    steps = ["""
kept AS MATERIALIZED (
  SELECT vec_id, label, v, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r
  FROM (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
parts AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM kept, (SELECT unnest(range(4)) AS p)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS y FROM parts WHERE r <= 256)"""]
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
  SELECT r, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS best
  FROM (SELECT r, p, x, e, list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y) AS d
        FROM parts JOIN book{i} USING (p)) GROUP BY r, p)""")
        if i < rounds:
            steps.append(f"""
book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.y, b.y) AS y FROM book{i} b LEFT JOIN (
    SELECT p, e, list(c ORDER BY k) AS y FROM (
      SELECT p, best.e AS e, k, floor(sum(x[k]) / count(*)) AS c
      FROM near{i}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS k) GROUP BY 1, 2, 3)
    GROUP BY 1, 2) m USING (p, e))""")
    return "WITH " + ",".join(steps) + f""",
digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(y, lambda c: CAST(CAST(c AS BIGINT) AS VARCHAR)), ','), ','
                           ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}),
coded AS (
  SELECT r, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (r), digest
"""


VECTOR_CODES = _vector_codes_sql()
