from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_mixing import filled
from tests.llm.test_simhash import brute_components, brute_fingerprint
from tiffin.llm import common
from tiffin.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = common.table(spark, SF, "documents")
    kept, frame = {r.doc_id: r for r in docs.collect()}, docs
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "decontamination", "mixing"]
    for name, stage in corpus_pipeline.STAGES:
        out = common.staged(stage(spark, frame, SF), "test")
        rows = out.collect()
        if name == "quality":
            good = {r.doc_id for r in QUERIES["op5_quality"](spark, SF).collect() if r.predicted}
            want = {i for i in kept if i in good}
            assert 0 < len(want) < len(kept)
        elif name == "exact_dedup":
            best = {}
            for i, r in kept.items():
                best[r.text] = max(best.get(r.text, i), i)
            want = set(best.values())
        elif name == "near_dedup":
            ids = sorted(kept)
            comp = brute_components([brute_fingerprint(kept[i].text) for i in ids], 4)
            want = {min(i for i, c in zip(ids, comp) if c == own) for own in set(comp)}
        elif name == "decontamination":
            items = [tuple(r) for r in common.table(spark, SF, "benchmark").select("item_id", "text").collect()]
            want = {r[0] for r in brute_hits([(i, r.text) for i, r in kept.items()], items) if not r[4]}
        else:
            sizes, taken = defaultdict(int), defaultdict(int)
            for r in rows:
                sizes[r.source] += r.size
                taken[r.source] += r.taken
            assert {r.doc_id: r.size for r in rows} == {i: len(r.text.split()) for i, r in kept.items()}
            target = filled(sizes, [5, 2, 1], 1.5, 2.0)
            assert all(r.target == pytest.approx(target[r.source]) for r in rows)
            assert all(abs(taken[s] - target[s]) <= max(r.size for r in rows if r.source == s) for s in sizes)
            break
        assert out.columns == docs.columns
        assert sorted(r.doc_id for r in rows) == sorted(want)
        assert all(r == kept[r.doc_id] for r in rows)
        kept, frame = {r.doc_id: r for r in rows}, out


def test_filters_with_clashing_columns(spark, edge_docs):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge_docs, SF)
        if name != "mixing":
            assert out.columns == edge_docs.columns
        assert 0 < out.count() <= edge_docs.count()
