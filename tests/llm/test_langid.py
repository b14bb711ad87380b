import zlib

import numpy as np
import pyarrow as pa

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import langid
from tiffin.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    got = QUERIES["op7_langid"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert len(held) > 150 and np.mean([r.lang_pred == r.lang for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_gradients_match_differences():
    net = langid.Network(["a", "b", "c"], units=3)
    for s in (net.forward, net.backward, net.out):
        for k in s:
            s[k] = s[k].astype(np.float32) * np.float32(0.5)
    rng = np.random.default_rng(0)
    x, real, y = rng.integers(0, 256, (6, 4)), np.ones((6, 4), bool), np.array([0, 1, 2, 1])
    real[5, 0] = False
    loss, grads = net.gradients(x, real, y)
    for s, g in zip((net.forward, net.backward, net.out), grads):
        for k in s:
            at = tuple(int(rng.integers(n)) for n in s[k].shape)
            if k[0] == "E":
                at = (int(x[2, 1]), at[1])
            old, step = s[k][at], np.float32(1e-2)
            s[k][at] = old + step
            up = net.gradients(x, real, y)[0]
            s[k][at] = old - step
            down = net.gradients(x, real, y)[0]
            s[k][at] = old
            assert abs((up - down) / (2 * step) - g[k][at]) < 2e-3 + 0.05 * abs(g[k][at]), k


def test_windows_cover_every_byte():
    texts = pa.array(["", "a" * 64, "b" * 65, None, "c" * 200, "d"])
    from tiffin.llm import tokens
    for _, _, data, offsets in tokens.pieces(texts):
        x, real, row = langid.windows(data, offsets)
        for i in range(len(offsets) - 1):
            own = x[:, row == i].T[real[:, row == i].T]
            assert bytes(own.astype(np.uint8)) == bytes(data[offsets[i]:offsets[i + 1]])


def test_documents_do_not_depend_on_the_batch():
    net = langid.Network(["a", "b"])
    texts = pa.array(["x y" * 5_000, None, "", "é" * 700_000, "short"])
    together = net.documents(texts)
    alone = np.concatenate([net.documents(texts[i:i + 1]) for i in range(len(texts))])
    assert np.allclose(together, alone, atol=1e-5)
    assert np.allclose(together.sum(axis=1), [1, 0, 0, 1, 1], atol=1e-4)


def test_edges(edge_docs, no_docs):
    got = langid.identify(edge_docs).collect()
    assert len(got) == len(EDGE_ROWS)
    for r in got:
        text = [t for i, t, *_ in EDGE_ROWS if i == r.doc_id]
        if not any(any(c.isalpha() for c in t or "") for t in text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert langid.identify(no_docs).count() == 0
    from pyspark.sql import functions as F
    nameless = langid.identify(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nameless} == {"und"}


def test_blocks_are_the_windows_in_order():
    rng = np.random.default_rng(3)
    for sizes in ([0, 5, 64, 0, 129, 1], [0], [], [1000]):
        offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
        data = rng.integers(1, 256, int(offsets[-1])).astype(np.uint8)
        whole = langid.windows(data, offsets)
        for most in (1, 2, 7):
            blocks = list(langid.window_blocks(data, offsets, most))
            assert all(b[0].shape[1] <= most for b in blocks)
            for k, axis in enumerate((1, 1, 0)):
                parts = [b[k] for b in blocks]
                assert np.array_equal(np.concatenate(parts, axis) if parts else whole[k], whole[k])


def test_very_long_text_takes_memory_of_a_block():
    import tracemalloc
    net, texts = langid.Network(["a", "b"]), pa.array(["ab cd " * 2_000_000])
    tracemalloc.start()
    got = net.documents(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got.sum(), 1, atol=1e-3)
    assert peak < 250e6  # of a text of 12 MB; the windows of all of it took as much alone


def gate(x):
    return min(1, max(0, x / 4 + 0.5)) if np.isscalar(x) else np.array([gate(float(v)) for v in x])


def test_forward_pass_against_one_byte_at_a_time():
    """The whole-text probabilities from the textbook recurrence, in plain loops."""
    net, text = langid.Network(["a", "b", "c"], units=4), "naïve café " * 9

    def states(p, seen):
        h, out = np.zeros(4), []
        for b in seen:
            z, r = (gate(p[f"E{g}"][b] + h @ p[f"U{g}"]) for g in "zr")
            n = np.tanh(p["En"][b] + r * (h @ p["Un"]))
            h = (1 - z) * n + z * h
            out.append(h)
        return out
    data, total = text.encode(), np.zeros(3)
    for i in range(0, len(data), langid.SPAN):
        own = list(data[i:i + langid.SPAN])
        padded = own + [0] * (langid.SPAN - len(own))
        ahead, back = states(net.forward, padded), states(net.backward, padded[::-1])[::-1]
        for k in range(len(own)):
            e = np.exp(np.concatenate((ahead[k], back[k])) @ net.out["W"] + net.out["b"])
            total += e / e.sum()
    assert np.allclose(net.documents(pa.array([text]))[0], total / len(data), atol=1e-4)
