"""SimHash near-dedup over pivot distance tables.

A document's fingerprint is the bitwise majority of its word shingles'
64-bit hashes.  Equal fingerprints collapse first, so groups of copies of any
size are one row from there on.

Two fingerprints link at a Hamming distance of at most ``radius``.  By the
triangle inequality |d(x, p) - d(y, p)| <= d(x, y) for every reference
fingerprint (pivot) p, so a pair whose distances to some pivot differ by more
than ``radius`` is no link.  The pivots come in two kinds.

* Block pivots see one of ``radius + 3`` blocks of the 64 bits.  A link
  differs in at most ``radius`` blocks, so in at least three the distances to
  all of the block's pivots (zero and its unit vectors) coincide.  These
  distances determine the block's bits, hence a fingerprint is dealt to one
  bucket for every choice of three blocks, and each link shares a bucket.
* Full pivots are random fingerprints.  Within a bucket the table of
  distances to them is computed once; pairs whose largest coordinate
  difference exceeds ``radius`` are discarded and the survivors verified.
  A bucket returns a spanning set of its links, less than one per member.

A bucket of more than ``pair_limit`` distinct fingerprints is not compared by
pairs.  Members x and y of it link if and only if some z, equal to both in
the bucket's blocks, lies within radius/2 of each (half of their differing
bits flipped).  So every member is dealt to all such z and linked to the
smallest member that meets there: exact, linear in the bucket's size, and an
aggregation without any large group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.common import in_batches, staged
from tiffin.llm.components import components

HASH_SEED = 42
RADIUS = 4
SHINGLE = 4
EQUAL_BLOCKS = 3
PAIR_LIMIT = 1024
N_PIVOTS = 32


# ---- fingerprints -------------------------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one whole text (0 if it has no word)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    digest, counts, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64), max(1, n - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[shingle - 1:] if n > shingle else ends[-1:]
    for i in range(0, total, 65_536):  # long texts in pieces: 64 bytes for each shingle
        part = slice(i, min(i + 65_536, total))
        hashes = np.array([digest(joined[a:b], HASH_SEED)
                           for a, b in zip(starts[part].tolist(), ends[part].tolist())], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << int(i) for i in np.flatnonzero(counts * 2 > total))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): one row per input row, the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("t"))
    id_field = pa.field("doc_id", _arrow_type(rows, "doc_id"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(1)),
                              np.uint64, batch.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)],
                                             schema=pa.schema([id_field, pa.field("fp", pa.int64())]))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_batches(rows).mapInArrow(part, f"doc_id {kind}, fp long")


def _arrow_type(rows: DataFrame, col: str):
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(rows.schema[col].dataType)


# ---- pivots and buckets -------------------------------------------------------------------------

def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """``n`` fixed random reference fingerprints."""
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}", HASH_SEED) for i in range(n)], np.uint64)


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints (rows) to references (columns)."""
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def blocks(radius: int) -> list[int]:
    """Masks of ``radius + EQUAL_BLOCKS`` blocks of adjoining bits."""
    n = radius + EQUAL_BLOCKS
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]


def bucket_masks(radius: int) -> list[int]:
    """For every choice of EQUAL_BLOCKS blocks the mask of their bits."""
    return [sum(c) for c in combinations(blocks(radius), EQUAL_BLOCKS)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_rows(fps: DataFrame, radius: int) -> DataFrame:
    """(choice, key, fp): each distinct fingerprint in its bucket for every choice of blocks.

    The key is the fingerprint's bits in the chosen blocks, which stand for
    its distances to the pivots of these blocks.
    """
    buckets = F.array(*[F.struct(F.lit(i).cast("short").alias("choice"),
                                 F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                        for i, m in enumerate(bucket_masks(radius))])
    return fps.select("fp", F.explode(buckets).alias("b")).select("b.choice", "b.key", "fp")


def bucket_links(fps: np.ndarray, radius: int, refs: np.ndarray) -> list[tuple[int, int]]:
    """A spanning set of the links among the distinct fingerprints of one bucket."""
    n, links = len(fps), []
    root = np.arange(n)
    table = distance_table(fps, refs)
    for i in range(n - 1):
        rest = np.flatnonzero(root[i + 1:] != root[i]) + i + 1  # not yet in one component with i
        if not len(rest):
            continue
        near = rest[np.abs(table[rest] - table[i]).max(axis=1) <= radius]  # by the pivots
        near = near[np.bitwise_count(fps[near] ^ fps[i]) <= radius]  # verified
        for j in near:
            if root[j] != root[i]:
                links.append((i, int(j)))
                root[root == root[j]] = root[i]
    return links


def _links_of_sorted(batches: Iterator[pa.RecordBatch], radius: int, n_pivots: int) -> Iterator[pa.RecordBatch]:
    """Links of the buckets in rows (choice, key, fp) that come sorted; holds a batch and a bucket at most."""
    refs, held = pivots(n_pivots), None
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(c, k, f):
        out = []
        cut = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
        for a, b in zip([0, *cut], [*cut, len(f)]):
            if b - a > 1:
                own = f[a:b]
                out += [(own[i], own[j]) for i, j in bucket_links(own.view(np.uint64), radius, refs)]
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], schema=schema)

    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        c, k, _ = now
        if not len(c):
            continue
        last = np.flatnonzero((c != c[-1]) | (k != k[-1]))
        start = int(last[-1]) + 1 if len(last) else 0  # the last bucket may go on
        if start:
            yield links(*(x[:start] for x in now))
        held = [x[start:] for x in now]
    if held is not None:
        yield links(*held)


def _meeting_links(members: DataFrame, radius: int) -> DataFrame:
    """Links in large buckets: members that meet at a point within radius/2 of each."""
    masks, half = bucket_masks(radius), radius // 2
    flips = []
    for i, m in enumerate(masks):
        free = [1 << b for b in range(64) if not m >> b & 1]
        near = [sum(x) for k in range(half + 1) for x in combinations(free, k)]
        flips.append((i, [_signed(x) for x in near]))
    spark = members.sparkSession
    table = spark.createDataFrame(flips, "of short, flips array<long>")  # one row a choice of blocks
    at = (members.join(F.broadcast(table), F.col("choice") == F.col("of"))
          .select("choice", "fp", F.explode("flips").alias("flip"))
          .select("choice", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("z")))
    met = at.groupBy("choice", "z").agg(F.min("fp").alias("b"))
    # each member with the smallest member at the same z: the aggregation joined back, both sides dealt by (choice, z)
    return (at.join(met.hint("merge"), ["choice", "z"]).where("fp <> b").select(F.col("fp").alias("a"), "b").distinct())


def near_links(fps: DataFrame, radius: int = RADIUS, n_pivots: int = N_PIVOTS,
               pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links (a, b) that connect exactly what links within ``radius`` connect, from distinct (fp)."""
    if radius % 2:
        raise ValueError("radius is even: large buckets meet half way")
    rows = bucket_rows(fps, radius)
    shared = (rows.groupBy(F.col("choice").alias("c"), F.col("key").alias("k"))
              .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # merge: Spark takes the exploded side for as small as the fingerprints it comes from
    members = staged(rows.join(shared.hint("merge"), (F.col("choice") == F.col("c")) & (F.col("key") == F.col("k")))
                     .select("choice", "key", "fp", "n"), "simhash-members")
    small = (members.where(F.col("n") <= pair_limit).select("choice", "key", "fp")
             .repartition("choice", "key").sortWithinPartitions("choice", "key", "fp"))
    links = in_batches(small).mapInArrow(lambda it: _links_of_sorted(it, radius, n_pivots), "a long, b long")
    return links.union(_meeting_links(members.where(F.col("n") > pair_limit), radius))


# ---- the operator -------------------------------------------------------------------------------

def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS, n_pivots: int = N_PIVOTS,
                    pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """One row per input row: doc_id, fp (signed long), component_id, component_size.

    ``component_id`` is the smallest doc_id that links reach, the row's own
    included (null ids come last; null only if all are null);
    ``component_size`` counts rows.  Null and wordless texts have fingerprint
    zero and link like any other.  Rows that repeat get the same result; an
    empty table gives an empty one; other columns are not read.
    """
    rows = staged(fingerprints(docs, id_col, text_col, shingle), "simhash-fps")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")),
                     "simhash-classes")
    roots = components(near_links(classes.select("fp"), radius, n_pivots, pair_limit))
    rooted = staged(classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "n", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_size"))
    named = rooted.select("fp", "root").join(whole, "root").select(
        F.col("fp").alias("of"), "component_id", "component_size")
    return rows.join(named, F.col("fp") == F.col("of")).select(
        "doc_id", "fp", "component_id", "component_size")


def fingerprint_hex(fp: Column) -> Column:
    """16 lowercase hex digits of a signed-long fingerprint column."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
