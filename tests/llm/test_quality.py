import zlib

import numpy as np
import pyarrow as pa

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import quality
from tiffin.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    got = QUERIES["op5_quality"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert len(held) > 500
    assert np.mean([r.predicted == r.quality for r in held]) > 0.99
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.995
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    assert (quality.fit(docs, labels) == quality.fit(docs, turned)).all()


def test_scores_do_not_depend_on_the_batch():
    texts = pa.array([None, "", "one two, two two!!", "x" * 3_000_000, "AND | THE | of"])
    w = np.random.default_rng(0).normal(size=(1 << quality.BITS) + 1).astype(np.float32)
    together = quality.scores(texts, w)
    alone = np.concatenate([quality.scores(texts[i:i + 1], w) for i in range(len(texts))])
    assert np.allclose(together, alone) and together[0] == together[1]


def test_sparse_dot_product_matches_dense():
    text = "The the, cat sat! sat sat on THE mat."
    row, f = quality.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 10)
    w = np.random.default_rng(1).normal(size=(1 << 10) + 1).astype(np.float32)
    x = np.bincount(f, minlength=1 << 10) * (quality.MASS / len(f))
    want = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    assert np.isclose(quality.scores(pa.array([text]), w, 10)[0], want, rtol=1e-4)


def test_ftrl_separates():
    m = quality.Ftrl(4)
    for _ in range(50):
        m.learn(np.array([1]), np.array([1.0]), 1)
        m.learn(np.array([2]), np.array([1.0]), 0)
    w = m.weights()
    assert w[1] > 1 and w[2] < -1 and w[3] == 0


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, 1), (6, None), (None, 1), (99, 0), (7, 1)], "doc_id long, quality int")
    got = quality.score_quality(edge_docs, labels).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    none = quality.score_quality(edge_docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.score_quality(no_docs, labels).count() == 0
    kept = quality.keep_quality(edge_docs, labels, threshold=0.0)
    assert kept.columns == edge_docs.columns and kept.count() == len(EDGE_ROWS)
