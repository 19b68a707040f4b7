import re

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from footfall.llm import token_counts as T
from tests.llm.helpers import ODD, empty_documents, odd_documents, rows_of

RANKS = T.read_vocabulary(T.VOCABULARY)
ENCODER = T.Encoder(RANKS, T.PATTERN)


def brute(text, ends, rule):
    """Character by character: which token holds it, then the rule for each token."""
    ids = ENCODER.encoding.encode_ordinary(text)
    owner, at = [], 0
    byte_owner = [t for t, i in enumerate(ids) for _ in range(len(ENCODER.encoding.decode_single_token_bytes(i)))]
    for ch in text:
        owner.append(byte_owner[at])
        at += len(ch.encode())
    section = lambda c: next(i for i, e in enumerate(ends) if c < e)
    counts = [0.0] * len(ends)
    byte_char = [c for c, ch in enumerate(text) for _ in ch.encode()]
    for t in range(len(ids)):
        chars = [c for c, o in enumerate(owner) if o == t] or [byte_char[byte_owner.index(t)]]
        where = [section(c) for c in chars]
        if rule == "first":
            counts[where[0]] += 1
        elif rule == "most":
            counts[max(sorted(set(where)), key=where.count)] += 1
        else:
            for w in where:
                counts[w] += 1 / len(where)
    return counts


@pytest.mark.parametrize("rule", T.RULES)
@given(st.text(alphabet="ab \n\n!é漢\U0001F600", max_size=25))
def test_against_brute_force(rule, text):
    whole, spans = T.sections([text], "\n", re.compile(r"\n"))
    assert whole == text and spans[-1][2] == len(text)
    ends = np.array([e for _, _, e in spans])
    counts, _ = T.attribute(ENCODER.token_ends(text), text.encode(), ends, rule)
    if text:
        assert np.allclose(counts, brute(text, ends.tolist(), rule))
    else:
        assert counts.tolist() == [0.0]


def test_fields_touch_and_tokens_may_cross():
    text, spans = T.sections(["ab", "", "cd\nef"], " ", re.compile(r"\n+"))
    assert text == "ab  cd\nef" and spans == [(0, 0, 3), (1, 3, 4), (2, 4, 7), (2, 7, 9)]


def test_long_texts_are_encoded_in_pieces(monkeypatch):
    text = "some words, 123 and more words  here\n" * 40
    whole = ENCODER.token_ends(text).tolist()
    monkeypatch.setattr(T, "PIECE", 50)
    assert len(list(T._pieces(text))) > 10
    assert ENCODER.token_ends(text).tolist() == whole


@pytest.mark.parametrize("rule", T.RULES)
def test_counts_add_up(spark, rule):
    found = rows_of(T.count_tokens(odd_documents(spark), fields=("source", "text"), rule=rule))
    totals = {}
    for r in found:
        totals.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r["tokens"])
    for i, text, _, source in ODD:
        n = len(ENCODER.encoding.encode_ordinary((source or "") + "\n" + (text or "")))
        assert (i, n) in totals
    assert all(abs(sum(v) % n) < 1e-6 or abs(sum(v) % n - n) < 1e-6 for (_, n), v in totals.items() if n)


def test_rules_and_empty(spark):
    with pytest.raises(ValueError):
        T.count_tokens(empty_documents(spark), rule="last")
    assert T.count_tokens(empty_documents(spark)).count() == 0
