from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.llm import toxicity as X
from footfall.llm.common import id_remainder, table
from tests.llm.helpers import empty_documents, odd_documents, rows_of
from tests.oracle import TESTDATA

ENTRIES = [X.Entry(w, False, 4.0, 2.0) for w in ("stupid", "moron", "disgusting", "abc")] + [X.Entry("grumb", True, 3.0)]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i]
    for j, y in enumerate(b, 1):
        out.append(min(row[j - 1] + (x != y), row[j] + 1, out[-1] + 1))
    return out


@given(st.text(alphabet="moranstupid", max_size=9), st.integers(0, 2))
def test_automaton_against_edit_distance(word, most):
    trie = X.build_trie(ENTRIES)
    expected = {(distance(word, e.text), e.text) for e in ENTRIES if not e.start and distance(word, e.text) <= most}
    assert {(d, e.text) for d, e in X.fuzzy_find(word, trie, most)} == expected


@given(st.sampled_from([e.text for e in ENTRIES if not e.start and len(e.text) >= X.MIN_FUZZY]), st.integers(0, 10),
       st.sampled_from("aeiou1x"), st.sampled_from(["put", "cut", "change"]))
def test_no_misspelling_is_filtered_out(word, at, letter, edit):
    at = min(at, len(word) - 1)
    other = {"put": word[:at] + letter + word[at:], "cut": word[:at] + word[at + 1:],
             "change": word[:at] + letter + word[at + 1:]}[edit]
    for edits in (1, 2):
        found = X.Lexicon(ENTRIES, edits).look_up(other)
        assert found is not None and found[0] == distance(other, word) and found[1].text == word


def test_context_separates_quotation_from_abuse():
    lexicon = X.Lexicon(ENTRIES)
    plain = X.evidence("what a moron he is today", lexicon)[0]
    assert X.evidence('they wrote "moron" on it', lexicon)[0] < plain < X.evidence("you moron", lexicon)[0]
    assert X.evidence("grumbling and grumb", lexicon)[:3] == (6.0, 0.0, 2)
    assert X.evidence("m0ron", lexicon) == (0.0, 2.0, 1, {"moron": True})
    assert X.evidence("abd", lexicon)[2] == 0  # too short for misspellings
    assert X.evidence(None, lexicon) == X.evidence("", lexicon) == (0.0, 0.0, 0, {})


def test_choice_of_entries():
    rows = [("lowei", True, 60, 0), ("loweia", False, 30, 0), ("low", True, 80, 400), ("the", False, 100, 1000),
            ("idiot", False, 50, 0), ("idio", True, 50, 0), ("rare", False, 2, 0)]
    chosen = X.choose_entries(rows, 1000, 9000, 12.0)
    assert [(e.text, e.start) for e in chosen] == [("lowei", True), ("idiot", False)]


def test_held_out_accuracy_and_copies_do_not_vote(spark):
    docs, labels = table(spark, f"{TESTDATA}/sf0.1", "documents"), table(spark, f"{TESTDATA}/sf0.1", "labels")
    held_out = id_remainder(F.col("doc_id"), 5) == 0
    one = docs.join(labels.where("toxic = 1 and doc_id % 5 = 1"), "doc_id").orderBy("doc_id").limit(1).select("text")
    copies = spark.range(1_000_000, 1_000_400).withColumnRenamed("id", "doc_id").crossJoin(F.broadcast(one))
    more = docs.select("doc_id", "text").unionByName(copies)
    known = labels.where(~held_out).select("doc_id", "toxic").unionByName(copies.select("doc_id", F.lit(1).alias("toxic")))
    model = X.learn(more, known)
    assert 5 < len(model.entries) < 60  # the copies' other words are no entries
    row = X.score_documents(docs, model).join(labels.where(held_out), "doc_id").agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("double")), F.count("*")).first()
    assert row[0] > 0.97 and row[1] > 500


def test_odd_texts_and_missing_classes(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    for known in (labels, labels.where("toxic = 0"), labels.where("false")):
        model = X.learn(docs, known)
        found = rows_of(X.score_documents(docs, model))
        assert len(found) == docs.count() and all(0 <= r["score"] <= 1 for r in found)
    assert X.drop_toxic(docs, model).columns == docs.columns
    assert X.score_documents(empty_documents(spark), model).count() == 0
    assert X.learn(empty_documents(spark), labels).entries == ()


def test_misspellings_of_words_that_a_start_covers(spark):
    toxic = [f"a{i} idiot b{i} sunny" for i in range(130)] + ["one idiots here", "my idiotic plan"]
    clean = [f"a{i} river b{i} sunny" for i in range(260)]
    docs = spark.createDataFrame(list(enumerate(toxic + clean)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") < len(toxic)).cast("int").alias("toxic"))
    model = X.learn(docs, labels)
    assert any(e.start and "idiot".startswith(e.text) for e in model.entries)
    lexicon = X.Lexicon(list(model.entries), model.edits)
    for word, edits in (("1diot", 1), ("ideot", 1), ("idiot", 0), ("idiots", 0)):
        assert lexicon.look_up(word)[0] == edits
    assert lexicon.look_up("ideology") is None
    start = next(e for e in model.entries if e.start)
    assert lexicon.look_up("idiot")[1].weight == start.weight  # exact finds weigh what they did


def test_a_labelled_id_with_very_many_rows_keeps_the_sample_bounded(spark, monkeypatch):
    monkeypatch.setattr(X, "TOXIC_ROWS", 20)
    monkeypatch.setattr(X, "CLEAN_ROWS", 40)
    docs = spark.createDataFrame(
        [(1, f"you are an idiot {i}") for i in range(3000)] + [(1, "same")] * 500 + [(i, f"fine text {i}") for i in range(2, 30)],
        "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 30)], "doc_id long, toxic int")
    sample, share = X.sample_labelled(docs, labels)
    rows = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    assert rows[1] < 80 and rows[0] == 28 and 0 < share[1] < 0.05 and share[0] == 1.0
