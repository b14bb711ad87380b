from collections import defaultdict

import pytest

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import mixing


def filled(sizes, weights, share, cap):
    """Targets by sharing again and again what full sources leave."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if unit * w[s] > cap * sizes[s]}
        if not full:
            return out | {s: unit * w[s] for s in open_}
        for s in full:
            out[s] = cap * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def test_targets(spark):
    sizes = {"a": 100, "b": 1000, "c": 30, "d": 5000, "e": 1, None: 77, "é": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for share, cap in ((1.5, 2.0), (0.5, 1.0), (3.0, 2.0)):
        got = {r.source: r.target for r in mixing.source_targets(df, [5, 2, 1], share, cap).collect()}
        assert got == pytest.approx(filled(sizes, [5, 2, 1], share, cap))


def test_taken_is_near_the_target_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs, [5, 2, 1], 1.5).collect()
    again = mixing.mix(docs.repartition(7), [5, 2, 1], 1.5).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    taken, largest, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in target)


def test_smaller_budgets_nest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    few, more = ({r.doc_id for r in mixing.mix(docs, [1], s, 1.0).collect() if r.copies} for s in (0.2, 0.6))
    assert few < more


def test_edges(edge_docs, no_docs, spark):
    got = mixing.mix(edge_docs, [5, 2, 1], 1.5).collect()
    assert len(got) == len(EDGE_ROWS)
    sizes = defaultdict(int)
    for _, text, _, source in EDGE_ROWS:
        sizes[source] += len((text or "").split())
    target = filled(sizes, [5, 2, 1], 1.5, 2.0)
    assert all(r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) for r in got)
    assert mixing.mix(no_docs, [5, 2, 1], 1.5).count() == 0
    wordless = spark.createDataFrame([(1, None, "a"), (2, "", "b")], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mix(wordless, [5, 2, 1], 1.5).collect()} == {(0.0, 0)}
