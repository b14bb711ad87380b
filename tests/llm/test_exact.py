import hashlib
from collections import Counter

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import exact


def brute(rows):
    best = {}
    for doc_id, text in rows:
        key = -1 if doc_id is None else doc_id
        best[text or ""] = max(best.get(text or "", -1), key)
    n = Counter(t or "" for _, t in rows)
    return {(d, None if best[t or ""] < 0 else best[t or ""], n[t or ""], hashlib.sha256((t or "").encode()).hexdigest())
            for d, t in rows}


def test_edges_match_brute_force(edge_docs):
    got = exact.exact_duplicates(edge_docs).collect()
    assert len(got) == len(EDGE_ROWS)
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == brute([r[:2] for r in EDGE_ROWS])
    # one row of each distinct text stays, repeated rows included
    assert sorted(Counter(r.text_sha256 for r in got if r.kept).values()) == [1] * len({r[1] or "" for r in EDGE_ROWS})


def test_many_runs_merge_in_rounds(spark):
    rows = [(i, f"text {i % 7 if i % 3 else 0}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(37)
    for keep, pick in (("max", max), ("min", min)):
        got = exact.exact_duplicates(df, keep=keep, fan_in=2).collect()
        want = {}
        for i, t in rows:
            want.setdefault(t, []).append(i)
        assert len(got) == 500
        assert all(r.keep_id == pick(want[rows[r.doc_id][1]]) and r.kept == (r.doc_id == r.keep_id) for r in got)


def test_normalised(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "A b"), (2, "a B")], "doc_id long, text string")
    assert {r.keep_id for r in exact.exact_duplicates(df, normalise=F.lower).collect()} == {2}


def test_rows_that_stay(edge_docs, spark):
    got = exact.drop_exact_duplicates(edge_docs)
    assert got.columns == edge_docs.columns
    assert sorted(r.text or "" for r in got.collect()) == sorted({r[1] or "" for r in EDGE_ROWS})
    plain = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (3, "b", 7)], "doc_id long, text string, kept int")
    assert sorted(map(tuple, exact.drop_exact_duplicates(plain).collect())) == [(2, "a", 6), (3, "b", 7)]


def test_empty(no_docs):
    assert exact.exact_duplicates(no_docs).count() == 0
    assert exact.drop_exact_duplicates(no_docs).count() == 0
