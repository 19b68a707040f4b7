from itertools import combinations

from pyspark.sql import functions as F

from footfall.llm import url_rules as U
from tests.llm.helpers import rows_of


def judged(spark, urls, mined=None):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r["page_id"]: r for r in rows_of(U.filter_urls(pages, mined=[] if mined is None else mined))}


def test_host_path_and_longest_rule(spark):
    found = judged(spark, [
        "http://Example.ORG/es/1?x=/de/", "https://a.example.org/en/12#top", "https://a.example.org/en/2",
        "http://notexample.org/es/1", "http://x.com/de/1", "http://x.com/fr/1", "http://x.com/en/", "http://x.com",
        "http://org", "ftp://org/", "no scheme", None, "http://?q", "a://b://c/d", "http://X.com\n/fr/"])
    got = {i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in found.items()}
    assert got[0] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[1] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[2] == ("a.example.org", "/en/2", "org/", "allow")
    assert got[3] == ("notexample.org", "/es/1", "org/", "allow")
    assert got[4][2:] == ("com/de/", "block") and got[5][2:] == ("com/fr/", "allow")
    assert got[6][2:] == (None, "allow") and got[7] == ("x.com", "", None, "allow")
    assert got[8] == ("org", "", None, "allow") and got[9] == ("org", "/", "org/", "allow")
    assert got[10] == ("", "", None, "allow") and got[11] == ("", "", None, "allow")
    assert got[12] == ("", "", None, "allow") and got[13] == ("b:", "//c/d", None, "allow")
    assert got[14] == ("x.com\n", "/fr/", None, "allow")


def brute_rules(baskets, support, confidence):
    """All rules by trying every token set."""
    n, found = len(baskets), {}
    for tokens in {t for b, _ in baskets for k in range(1, len(b) + 1) for t in combinations(sorted(b), k)}:
        hit = [v for b, v in baskets if set(tokens) <= set(b)]
        for verdict in ("allow", "block"):
            k = hit.count(verdict)
            if k / n >= support and k / len(hit) >= confidence:
                found[tokens, verdict] = (round(k / len(hit), 9), round(k / n, 9))
    return found


def test_mined_rules_against_brute_force(spark):
    baskets = [(["a", "b"], "block"), (["a", "b", "c"], "block"), (["a", "c"], "allow"), (["b", "c"], "block"),
               (["d"], "allow"), (["d", "a"], "allow"), (["d", "c"], "allow"), (["b"], "block"), (["c"], "allow")] * 3
    labelled = spark.createDataFrame([(f"u{i}", t, v) for i, (t, v) in enumerate(baskets)],
                                     "url string, tokens array<string>, verdict string")
    mined = U.mine_rules(labelled, min_support=0.05, min_confidence=0.8)
    every = brute_rules(baskets, 0.05, 0.8)
    expected = U.prune([U.Mined(t, v, *x) for (t, v), x in every.items()])
    assert mined == expected


def test_best_rule_by_inverted_index(spark):
    mined = [U.Mined(("a", "b"), "block", 0.9, 0.1), U.Mined(("a",), "allow", 0.8, 0.5), U.Mined(("z",), "block", 1.0, 0.1)]
    rows = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"]), (3, ["b"]), (4, []), (5, ["z", "a"])],
                                 "id long, tokens array<string>")
    got = {r["id"]: r["v"] for r in rows_of(rows.select("id", U.fired_rule(F.col("tokens"), mined)["verdict"].alias("v")))}
    assert got == {1: "block", 2: "allow", 3: None, 4: None, 5: "block"}


def test_no_labels_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x", "keep")], "page_id long, url string, verdict string")
    assert [r["verdict"] for r in rows_of(U.filter_urls(pages))] == ["allow"]
    assert U.filter_urls(pages.where("false")).count() == 0


def test_plan_has_no_python(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    plan = U.filter_urls(pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
