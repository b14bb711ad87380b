import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE_ROWS
from tiffin.llm import merkle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*fields):
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def brute(rows):
    """rows: (group, doc_id, leaf, claim) -> sorted (doc_id, leaf, subroot, root, proof hash, folded root)."""
    groups = {}
    for g, doc_id, node, claim in rows:
        groups.setdefault(g, []).append((doc_id is not None, doc_id, node, claim))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([r[2] for r in sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2]))]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for rank, g in enumerate(names):
        for place, (_, doc_id, node, claim) in enumerate(sorted(groups[g], key=lambda r: (r[0], r[1] or 0, r[2]))):
            path, fold = [], claim or node
            for tree, at in ((trees[g], place), (top, rank)):
                for level in tree[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else ""
                    path.append(other)
                    fold = H(other, fold) if at % 2 else H(fold, other)
                    at //= 2
            out.append((doc_id, node, trees[g][-1][0], top[-1][0], H(*path), fold))
    return sorted(out, key=str)


def found(df):
    fold = merkle.fold(F.coalesce("claim", "node"), F.col("place"), F.col("n"), F.col("tree"), F.col("proof"))
    rows = df.select("doc_id", *[merkle.hex_of(F.col(c)).alias(c) for c in ("node", "subroot", "root")],
                     F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof"), fold.alias("folded")).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, "b": 1}, {"a": 16, "b": 17, None: 15}, {"a": 33, "b": 257, "c": 3},
                                   {f"g{i}": 1 + i % 3 for i in range(37)}])
def test_trees_of_all_shapes(spark, sizes):
    rows = [(i * 10 + len(str(g)), g, f"t{i}") for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(7)
    got = found(merkle.manifest(merkle.leaves(df, ["doc_id", "text"], "lang", "doc_id")))
    assert got == brute([(g, i, leaf(i, t), None) for i, g, t in rows])
    assert all(r[5] == r[3] for r in got)


def test_changed_rows_fail_and_no_others(spark):
    rows = [(i, "ab"[i % 5 > 1], f"t{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    claim = F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    got = found(merkle.manifest(merkle.leaves(df, ["text", "doc_id"], "lang", "doc_id", {"text": claim})))
    assert got == brute([(g, i, leaf(t, i), leaf(t + "!", i) if i % 9 == 0 else None) for i, g, t in rows])
    assert {r[0] for r in got if r[5] != r[3]} == set(range(0, 200, 9))


def test_contract(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = []
    for d in docs:
        hit = zlib.crc32(str(d.doc_id).encode()) % 7 == 0 and d.n_chars is not None
        rows.append((d.lang, d.doc_id, leaf(d.doc_id, d.source, d.lang, d.n_chars, d.text),
                     leaf(d.doc_id, d.source, d.lang, d.n_chars + 1, d.text) if hit else None))
    got = queries.op13_merkle(spark, sf).collect()
    assert sorted([tuple(r)[:6] for r in got], key=str) == brute(rows)
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    assert {r.doc_id for r in got if not r.verified} == {r[1] for r in rows if r[3]}


def test_edges(edge_docs, no_docs):
    df = edge_docs.withColumn("n_chars", F.length("text"))
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    got = found(merkle.manifest(merkle.leaves(df, fields, "lang", "doc_id")))
    assert got == brute([(g, i, leaf(i, s, g, None if t is None else len(t), t), None) for i, t, g, s in EDGE_ROWS])
    none = merkle.manifest(merkle.leaves(no_docs, ["text"], "lang", "doc_id"))
    assert none.count() == 0 and "proof" in none.columns


def test_one_hot_group(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 100 == 0, "x").otherwise("y").alias("lang"))
    got = found(merkle.manifest(merkle.leaves(df, ["doc_id"], "lang", "doc_id")))
    assert got == brute([("x" if i % 100 == 0 else "y", i, leaf(i), None) for i in range(3000)])
