import pytest

from footfall.llm.decontaminate import drop_contaminated, find_items
from tests.llm.helpers import empty_documents, odd_documents, rows_of

WORDS = [f"w{i}" for i in range(400)]


def line(start, stop):
    return " ".join(WORDS[start:stop])


@pytest.fixture(scope="module")
def tables(spark):
    swapped = WORDS[0:60]
    swapped[30] = "other"  # 5 of 56 shingles change
    torn = WORDS[0:60]
    for i in (10, 22, 34, 46):
        torn[i] = "other"  # 20 of 56 shingles change
    docs = spark.createDataFrame([
        (1, line(200, 300) + "! " + line(0, 60).upper() + " " + line(100, 200)), (2, line(200, 300)),
        (3, " ".join(swapped)), (4, " ".join(torn)), (5, line(80, 83)), (6, line(80, 82)), (None, line(0, 60)), (7, None),
        (8, line(310, 315) + " x " + line(310, 315)), (9, line(0, 60)), (9, line(0, 60))], "doc_id long, text string")
    items = spark.createDataFrame([
        (10, line(0, 60)), (11, line(80, 83)), (12, line(310, 315)), (13, ""), (14, None), (15, line(0, 60))],
        "item_id long, text string")
    return docs, items


@pytest.mark.parametrize("block_mb", [16, 0.0003])
def test_containment(tables, block_mb):
    found = {}
    for r in rows_of(find_items(*tables, block_mb=block_mb)):
        found.setdefault(r["doc_id"], []).append((r["item_id"], r["shared"], r["item_shingles"]))
    assert {k: sorted(v) for k, v in found.items()} == {
        1: [(10, 56, 56), (15, 56, 56)], 3: [(10, 51, 56), (15, 51, 56)], 5: [(11, 1, 1)], 8: [(12, 1, 1)],
        None: [(10, 56, 56), (15, 56, 56)], 9: [(10, 56, 56)] * 2 + [(15, 56, 56)] * 2}


def test_rows_are_dropped_by_their_own_text(tables):
    docs, items = tables
    assert sorted(r["doc_id"] for r in rows_of(drop_contaminated(docs, items))) == [2, 4, 6, 7]


def test_odd_and_empty_tables(spark, tables):
    docs, none = odd_documents(spark), tables[1].where("false")
    assert drop_contaminated(docs, none).columns == docs.columns
    assert drop_contaminated(docs, none).count() == docs.count() and find_items(docs, none).count() == 0
    assert drop_contaminated(docs, tables[1]).count() == docs.count()
    assert find_items(empty_documents(spark), tables[1]).count() == 0
