import random

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import simhash


def brute_fingerprint(text, shingle=4):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
             .translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
    shingles = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def cluster(rng, centre, n, steps):
    """Fingerprints by random walks of single flips from a centre."""
    out = []
    for _ in range(n):
        x = centre
        for _ in range(rng.randrange(steps)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def test_fingerprint():
    for _, text, *_ in EDGE_ROWS:
        if text is None or len(text) < 1000:
            assert simhash.fingerprint(text) == brute_fingerprint(text)
    long = " ".join(f"W{i % 977}" for i in range(70_000))
    assert simhash.fingerprint(long) == brute_fingerprint(long)
    assert simhash.fingerprint("\x1c a\u00a0b") == brute_fingerprint("\x1c a\u00a0b")


def test_spark_hash_agrees(spark):
    from pyspark.sql import functions as F
    got = spark.range(1).select(F.xxhash64(F.lit("the quick brown fox"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest("the quick brown fox", 42)


@pytest.mark.parametrize("pair_limit", [1024, 2])
def test_components_of_links(spark, pair_limit):
    """Both ways of a bucket, by pairs and by meeting points, against all pairs."""
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for centre in list(fps[:8]):
        fps += cluster(rng, centre, 25, 9)
    fps = list(dict.fromkeys(fps + [0]))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    from tiffin.llm.components import components
    roots = {r.node: r.root for r in components(simhash.near_links(df, 4, pair_limit=pair_limit)).collect()}
    groups = {}
    for f, want in zip(fps, brute_components(fps, 4)):
        signed = int(np.uint64(f).astype(np.int64))
        groups.setdefault(want, set()).add(roots.get(signed, signed))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_bucket_links_keep_components():
    rng = random.Random(3)
    fps = np.array(list(dict.fromkeys(cluster(rng, rng.getrandbits(64), 200, 12))), np.uint64)
    want = brute_components([int(f) for f in fps], 4)
    links = simhash.bucket_links(fps, 4, simhash.pivots())
    assert all(bin(int(fps[i] ^ fps[j])).count("1") <= 4 for i, j in links)
    assert len(links) == len(fps) - len(set(want))


def test_every_link_shares_a_bucket():
    rng = random.Random(1)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        assert any(x & m == y & m for m in simhash.bucket_masks(4))


def test_edges(edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == len(EDGE_ROWS)
    fps = [brute_fingerprint(t) for _, t, *_ in EDGE_ROWS]
    want, ids = brute_components(fps, 4), [r[0] for r in EDGE_ROWS]
    least = {c: min((i for i, w in zip(ids, want) if w == c and i is not None), default=None) for c in want}
    expect = sorted(((str(i), str(least[c]), want.count(c)) for i, c in zip(ids, want)))
    assert sorted((str(r.doc_id), str(r.component_id), r.component_size) for r in got) == expect
    assert simhash.near_duplicates(no_docs).count() == 0


def test_documents_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in rows]
    want = brute_components(fps, 4)
    least = {}
    for r, c in zip(rows, want):
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    from tiffin.llm.queries import QUERIES
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {r.doc_id: (f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, want)}
