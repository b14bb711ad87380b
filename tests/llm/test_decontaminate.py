import re

import pytest

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import decontaminate as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, width=10):
    windows = {}
    for item_id, text in items:
        w = words(text)
        for i in range(len(w) - min(width, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + width]), set()).add("" if item_id is None else str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    ids |= found
                    hit.update(range(i, i + n))
        out.append((doc_id, len(w), len(hit), tuple(sorted(ids)), bool(hit)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in df.collect()), key=str)


def test_given_tables(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet")
    docs, items = read("documents"), read("benchmark")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()],
                 [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(x[2] for x in want)
    assert result(dec.decontaminate(docs, items)) == want


def test_edges(spark, edge_docs, no_docs):
    items = [(1, "ONE"), (2, "the same id"), (3, None), (4, "..."), (5, "word word word"), (5, "word word word"),
             (10, "d-e-f g"), (None, "other"), (6, "word " * 12), (7, "not in any of them"), (8, "漢字")]
    idf = spark.createDataFrame(items, "item_id long, text string")
    got = dec.decontaminate(edge_docs, idf)
    assert result(got) == brute([r[:2] for r in EDGE_ROWS], items)
    assert dec.decontaminate(no_docs, idf).count() == 0
    none = dec.decontaminate(edge_docs, idf.limit(0))
    assert {r.contaminated for r in none.collect()} == {False} and none.count() == len(EDGE_ROWS)


def test_overlaps_and_borders(spark):
    body = " ".join(f"w{i}" for i in range(40))
    items = [("a", body), ("b", " ".join(f"w{i}" for i in range(5, 20))), ("10", "w1 w2"), ("9", "w3")]
    docs = [(1, body), (2, "x " + " ".join(f"W{i}" for i in range(3, 12)) + " y"), (3, body + " " + body),
            (4, " ".join(f"w{i}" for i in range(30, 40)) + "\nw1,w2"), (5, "w3")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id string, text string")
    assert result(dec.decontaminate(d, i)) == brute(docs, items)


def test_anchors():
    assert dec.window_anchors([5, 1, 9, 1], 10) == [(1, 3)]
    assert dec.window_anchors([5, 0, 9], 2) == []
    assert dec.window_anchors([3], 10) == [(0, 0)]
    assert dec.window_anchors([], 10) == []


def test_proximity(spark):
    docs = [(1, "the red big fox"), (2, "fox a b c d e f red"), (3, "red x fox red"), (4, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame([(1, "red fox")], "item_id long, text string")
    got = {(r.doc_id, r.start, r.end) for r in dec.proximity_matches(d, i, 3).collect()}
    assert got == {(1, 1, 4), (3, 0, 3), (3, 2, 4)}
    assert {r.doc_id for r in dec.proximity_matches(d, i, 8).collect()} == {1, 2, 3}


@pytest.mark.parametrize("delta,want", [(0, [(0, 3)]), (4, [(4, 7)]), (1, [])])
def test_spans(delta, want):
    assert dec.matched_spans(list("abcxabcd"), list("abc"), delta, 3) == want
