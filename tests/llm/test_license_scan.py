import re

import pytest

from footfall.llm.license_scan import compile_template, find, scan_licenses, start_table
from tests.llm.helpers import empty_documents, odd_documents, rows_of


def matches(wording, text):
    machine = compile_template("x", "notice", wording)
    return [i for i, _, _ in find(text.encode().split(), start_table([machine]))]


def test_mandatory_wording_has_to_match_exactly():
    assert matches("under the mit license", "it is under the mit license now under the mit license") == [2, 7]
    assert matches("under the mit license", "under the old mit license") == []


def test_optional_replaceable_and_alternative_regions():
    assert matches("a [b [c]] d", "a d a b d a b c d a c d") == [0, 2, 5]
    assert matches("a {1,2} z", "a z a x z a x y z a x y w z") == [2, 5]
    assert matches("a (b|c d) e", "a b e a c d e a c e") == [0, 3]
    assert matches("[a] b", "a b b") == [0, 1, 2]


def test_bad_templates_are_refused():
    for wording in ("a [b", "a ] b", "[a]", "{0,2} a"):
        with pytest.raises(ValueError):
            compile_template("x", "notice", wording)


def test_query_columns(spark):
    text = "Under THE Mit license; cc-by-nc! Apache License, Version 2.0 -- under the MIT\nlicense. cc by 4.0"
    docs = spark.createDataFrame([(1, text), (2, "mit license"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in rows_of(scan_licenses(docs))}
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
    assert (found[1]["n_words"], found[1]["n_base"], found[1]["first_word"], found[1]["last_word"]) == (
        len(words), 4, 0, 12)
    assert found[1]["base_labels"] == "apache-2,cc-by-nc,mit"
    assert found[1]["labels"] == "apache-2,cc-by,cc-by-nc,mit"
    assert (found[2]["n_words"], found[2]["n_base"], found[2]["first_word"], found[2]["score"]) == (2, 0, None, 0.0)
    assert (found[3]["n_words"], found[3]["labels"]) == (0, "")


def test_odd_and_empty_tables(spark):
    odd = odd_documents(spark)
    assert scan_licenses(odd).count() == odd.count()
    assert scan_licenses(empty_documents(spark)).count() == 0
