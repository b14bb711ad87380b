import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import periodic, queries

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in SPACE:
            out, word = out + [word] if word else out, ""
        else:
            word += c
    return out


def brute_runs(w):
    """Every period in turn: stretches of words equal to the word one period on; of equal stretches the smallest period."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def made(rnd):
    """Words with nested, adjoining and overlapping periodic stretches over a small vocabulary."""
    size, limit, out = rnd.choice([1, 2, 2, 3, 5]), rnd.choice([8, 40, 300]), []
    while len(out) < limit:
        if rnd.random() < 0.5:
            part = [rnd.randrange(size) for _ in range(rnd.randint(1, 12))]
            if rnd.random() < 0.4:
                part = part[:1] * rnd.randint(1, 9) + part
            out += (part * rnd.randint(1, 9))[:rnd.randint(1, 200)]
        else:
            out.append(rnd.randrange(size + 2))
    return [f"w{x}" for x in out[:rnd.randint(0, limit)]]


def test_runs_match_brute_force():
    rnd = random.Random(3)
    docs = [made(rnd) for _ in range(1500)]
    texts = [rnd.choice(["", " "]) + rnd.choice([" ", "\n", " \t "]).join(d) + rnd.choice(["", "\n"]) for d in docs]
    n, runs, left = (x.to_pylist() for x in periodic.scan_batch(pa.array(texts)))
    for d, k, found, text in zip(docs, n, runs, left):
        want = brute_runs(d)
        assert k == len(d)
        assert [(r["start"], r["length"], r["period"]) for r in found] == want
        assert text == brute_collapsed(d, want)


def test_range_queries():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 64, 1000):
        values = rng.permutation(n)
        tree = periodic.WaveletTree(values)
        lo = rng.integers(0, n, 200)
        hi = np.minimum(n, lo + 1 + rng.integers(0, n, 200))
        x = rng.integers(0, 2 * n, 200)
        assert tree.below(lo, hi, x).tolist() == [int((values[a:b] < c).sum()) for a, b, c in zip(lo, hi, x)]
        k = (hi - lo) // 2
        assert tree.smallest(lo, hi, k).tolist() == [int(np.sort(values[a:b])[c]) for a, b, c in zip(lo, hi, k)]


def test_suffixes():
    rng = np.random.default_rng(2)
    for n in (1, 5, 300):
        seq = np.append(rng.integers(0, 2, n), 9)
        sfx = periodic.Suffixes(seq)
        assert sfx.order.tolist() == sorted(range(n + 1), key=lambda i: seq[i:].tolist())
        i, j = rng.integers(0, n + 1, 100), rng.integers(0, n + 1, 100)
        i, j = i[i != j], j[i != j]
        same = [next((k for k in range(n + 2) if max(a, b) + k > n or seq[a + k] != seq[b + k])) for a, b in zip(i, j)]
        assert sfx.right(i, j).tolist() == same
        back = [next((k for k in range(n + 2) if min(a, b) - k < 1 or seq[a - k - 1] != seq[b - k - 1])) for a, b in zip(i, j)]
        assert sfx.left(i, j).tolist() == back


def contract(doc_id, text):
    w = words(text)
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    sha = [hashlib.sha256(x.encode()).hexdigest()
           for x in ("".join("%d,%d,%d\n" % r for r in runs), brute_collapsed(w, runs))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    got = queries.op12_periodic(spark, "/root/testdata/sf0.001").collect()
    want = {contract(r.doc_id, r.text) for r in rows}
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    assert sum(r.n_runs > 0 for r in got) > 5


def test_edges(edge_docs, no_docs, spark):
    got = periodic.periodic_runs(edge_docs).collect()
    want = sorted((str(i), len(words(t)), brute_collapsed(words(t), [(0, 60_000, 1)] if i == 5 else [])) for i, t, *_ in EDGE_ROWS)
    assert sorted((str(r.doc_id), r.n_words, r.collapsed) for r in got) == want
    assert [[tuple(x) for x in r.runs] for r in got if r.doc_id == 5] == [[(0, 60_000, 1)]]
    assert periodic.periodic_runs(no_docs).count() == 0
    changed = queries.with_periods(edge_docs).collect()
    assert len(changed) == len(EDGE_ROWS)
    # other control characters are no space
    odd = spark.createDataFrame([("x", "a\x1c b  " * 6)], "key string, body string")
    r = periodic.periodic_runs(odd, "key", "body").first()
    assert (r.doc_id, r.n_words, r.collapsed) == ("x", 6, "a\x1c b ")


@pytest.mark.parametrize("unit, times", [(["a"], 200_000), (["a", "b", "a", "a", "c"], 50_000), ([f"w{i}" for i in range(20_000)], 9)])
def test_very_long_texts(unit, times):
    n, runs, left = (x.to_pylist()[0] for x in periodic.scan_batch(pa.array([" ".join(unit * times)])))
    assert n == len(unit) * times and left == " ".join(unit)
    assert [tuple(r.values()) for r in runs if r["length"] == n] == [(0, n, len(unit))]
