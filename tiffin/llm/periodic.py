"""Periodic run detection by internal pattern matching.

A run is a stretch of consecutive words with smallest period q and at least
``max(MIN_WORDS, MIN_POWER * q)`` words that no neighbouring word extends.

The words of a batch of documents become one sequence of word numbers, with a
separator of its own behind every document.  Prefix doubling sorts its
suffixes; the ranks of a round are the suffix array intervals of all stretches
of 2**k words.  A run of period q holds, for the k with 2**k <= q < 2**(k+1),
an aligned (dyadic) block of 2**k words that occurs again q words later.  So
every block asks where it occurs in the neighbouring window of starts
[b + 2**k, b + 2**(k+1)): a range successor query in the block's interval, by
a wavelet tree over the suffix array.

Occurrences in such a window form one arithmetic progression.  One or two are
candidate periods as they are.  Of three or more, with difference d, only two
can belong to a run: block and occurrence lie in stretches of period d, and a
run long enough holds the right or the left ends of both, which then must lie
equally far from block and occurrence.  Each candidate is extended to both
sides by comparing ranks, longest stretches first; equal stretches keep their
smallest period.

Before all this, words that occur fewer than ``MIN_POWER`` times in their
stretch go, as every word of a run recurs that often in it; what they leave
falls into shorter stretches.  This loses no run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiffin.llm import tokens
from tiffin.llm.common import in_batches, text_or_empty

MIN_WORDS, MIN_POWER = 6, 4

RUNS = "array<struct<start:long,length:long,period:long>>"


def space_table() -> tuple[np.ndarray, np.ndarray]:
    """Byte classes of words by white space: 0 for space and 0x09 to 0x0D, else 1."""
    codes = np.arange(256)
    return np.where((codes == 32) | (codes >= 9) & (codes <= 13), 0, 1).astype(np.uint8), codes.astype(np.uint8)


# ---- suffixes -----------------------------------------------------------------------------------

class Suffixes:
    """Suffix array of a sequence of numbers, and the ranks of every round of prefix doubling.

    ``ranks[k][i]`` is the first place in the suffix array of the suffixes
    that share their first 2**k items with suffix i.
    """

    def __init__(self, seq: np.ndarray):
        n = self.n = len(seq)
        order = self.order = np.argsort(seq, kind="stable").astype(np.int64)
        rank, slots, step = np.empty(n, np.int64), np.arange(n), 1
        key = seq[order]
        self.ranks = []
        while True:
            # ``slots`` are the places of suffixes that were not yet told apart, ``key`` tells them apart now
            new = changes(key)
            first = np.flatnonzero(new)
            rank[order[slots]] = slots[first][np.cumsum(new) - 1]
            self.ranks.append(rank.astype(np.int32))
            size = np.diff(np.append(first, len(key)))
            slots = slots[np.repeat(size > 1, size)]
            if not len(slots):
                return
            at = order[slots]
            key = rank[at] * (n + 1) + np.where(at + step < n, rank[np.minimum(at + step, n - 1)] + 1, 0)
            by = np.argsort(key, kind="stable")
            order[slots], key = at[by], key[by]  # groups keep their places
            step *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many items are equal from i and j on, to the right; i and j differ."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):  # in the last round all ranks differ, so each step is taken once
            out += self._same(k, i + out, j + out) << k
        return out

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many items are equal before i and j, to the left; i and j differ."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            out += self._same(k, i - out - (1 << k), j - out - (1 << k)) << k
        return out

    def _same(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        inside = (np.minimum(i, j) >= 0) & (np.maximum(i, j) < self.n)
        rank, last = self.ranks[k], self.n - 1
        return (inside & (rank[np.clip(i, 0, last)] == rank[np.clip(j, 0, last)])).astype(np.int64)


def changes(ordered: np.ndarray) -> np.ndarray:
    """Whether each value of a sorted array is the first of its kind."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


class WaveletTree:
    """Counts and order statistics of the values in a stretch of an array of 0..n-1, in log n steps."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit) & 1 == 0
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(zero, out=zeros[1:])
            self.levels.append(zeros)
            values = np.concatenate((values[zero], values[~zero]))

    def below(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at lo..hi-1 are less than x."""
        out, beyond = np.zeros(len(lo), np.int64), x >= (1 << self.bits)
        size = hi - lo
        for depth, zeros in enumerate(self.levels):
            one = (x >> (self.bits - 1 - depth)) & 1 == 1
            z_lo, z_hi, ones = zeros[lo], zeros[hi], zeros[-1]
            out += np.where(one, z_hi - z_lo, 0)
            lo, hi = np.where(one, ones + lo - z_lo, z_lo), np.where(one, ones + hi - z_hi, z_hi)
        return np.where(beyond, size, out)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value of rank k (from 0) among those at lo..hi-1."""
        out = np.zeros(len(lo), np.int64)
        for depth, zeros in enumerate(self.levels):
            z_lo, z_hi, ones = zeros[lo], zeros[hi], zeros[-1]
            n_zero = z_hi - z_lo
            one = k >= n_zero
            k = np.where(one, k - n_zero, k)
            out += np.where(one, 1 << (self.bits - 1 - depth), 0)
            lo, hi = np.where(one, ones + lo - z_lo, z_lo), np.where(one, ones + hi - z_hi, z_hi)
        return out


# ---- runs ---------------------------------------------------------------------------------------

def candidates(sfx: Suffixes, tree: WaveletTree) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block start, period) pairs, level by level; each period is the distance to a later occurrence."""
    for k, rank in enumerate(sfx.ranks):
        step = 1 << k
        if step * MIN_POWER > sfx.n:
            return
        size = np.bincount(rank, minlength=sfx.n)
        block = np.arange(0, sfx.n, step)
        lo = rank[block].astype(np.int64)
        again = size[lo] > 1
        block, lo = block[again], lo[again]
        hi = lo + size[lo]
        before = tree.below(lo, hi, block + step)
        found = tree.below(lo, hi, block + 2 * step) - before
        some = found > 0
        block, lo, hi, before, found = block[some], lo[some], hi[some], before[some], found[some]
        if not len(block):
            continue
        first = tree.smallest(lo, hi, before)
        yield block[found < 3], (first - block)[found < 3]
        more = found > 1
        block, first, found = block[more], first[more], found[more]
        second = tree.smallest(lo[more], hi[more], before[more] + 1)
        yield block[found == 2], (second - block)[found == 2]
        block, first, d = block[found > 2], first[found > 2], (second - first)[found > 2]
        if len(block):
            # ends of the stretches of period d around the block and around its occurrences
            at_right = sfx.right(first, first + d) - sfx.right(block, block + d)
            at_left = sfx.left(block, block + d) - sfx.left(first, first + d)
            for q in (first - block + at_right, first - block + at_left):
                yield block[q > 0], q[q > 0]


def runs(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a sequence of numbers, by start, then length."""
    none = np.zeros(0, np.int64)
    if len(seq) < MIN_WORDS:
        return none, none, none
    sfx = Suffixes(seq)
    tree = WaveletTree(sfx.order)
    pairs = list(candidates(sfx, tree))
    if not pairs:
        return none, none, none
    block = np.concatenate([p[0] for p in pairs])
    q = np.concatenate([p[1] for p in pairs])
    inside = block + q < sfx.n
    block, q = block[inside], q[inside]
    start = block - sfx.left(block, block + q)
    length = block + q + sfx.right(block, block + q) - start
    long = length >= np.maximum(MIN_WORDS, MIN_POWER * q)
    start, length, q = start[long], length[long], q[long]
    by = np.lexsort((q, length, start))
    start, length, q = start[by], length[by], q[by]
    new = changes(start) | changes(length)
    return start[new], length[new], q[new]


def recurring(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, sequence): the words that may be in a run, as numbers, with a separator behind every stretch.

    ``places`` holds the word's place, or -1 for a separator.
    """
    def numbered():
        return np.unique(tokens.mix(key[place] ^ tokens.mix(stretch + np.uint64(1))), return_inverse=True, return_counts=True)

    place, stretch = np.arange(len(key)), row.astype(np.uint64)
    while len(place):
        before = len(place)
        _, number, count = numbered()
        place = place[count[number] >= MIN_POWER]
        cut = np.ones(len(place), bool)
        cut[1:] = (np.diff(place) > 1) | (row[place[1:]] != row[place[:-1]])
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, len(place)))
        keep = np.repeat(size >= MIN_WORDS, size)
        stretch, place = np.repeat(np.arange(len(first), dtype=np.uint64), size)[keep], place[keep]
        if len(place) > 0.8 * before:
            break
    if not len(place):
        return place, place
    number = numbered()[1]
    behind = np.append(np.flatnonzero(changes(stretch))[1:], len(place))
    return np.insert(place, behind, -1), np.insert(number, behind, number.max() + 1 + np.arange(len(behind)))


def find_runs(data: np.ndarray, offsets: np.ndarray) -> tuple:
    """Words and runs of the texts of a piece.

    Returns (token start, token length, token row) and, by row and start,
    (run row, first word within the row, length, period).
    """
    classes, values = space_table()
    start, length, row = tokens.token_spans(data, offsets, classes)
    if not len(start):
        none = np.zeros(0, np.int64)
        return (start, length, row), (none, none, none, none)
    places, seq = recurring(tokens.token_hashes(data, values, start, length), row)
    s, n, q = runs(seq)
    first_word = np.searchsorted(row, np.arange(len(offsets)), "left")
    place = places[s]
    return (start, length, row), (row[place], place - first_word[row[place]], n, q)


def collapsed(data: np.ndarray, n_rows: int, words: tuple, found: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts with the later periods of each run left out, words joined by one space."""
    start, length, row = words
    run_row, first, n, q = found
    base = np.searchsorted(row, np.arange(n_rows), "left")[run_row] + first
    change = np.zeros(len(start) + 1, np.int64)
    np.add.at(change, base + q, 1)
    np.add.at(change, base + n, -1)
    kept = np.cumsum(change[:-1]) == 0
    start, end, row = start[kept], (start + length)[kept], row[kept]
    # each kept word takes the byte behind it too, as its space, but for the last of a row
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    mark = np.zeros(len(data) + 2, np.int8)
    mark[start] = 1
    stop = end + ~last
    mark[stop] -= 1
    take = np.cumsum(mark[:len(data)], dtype=np.int8) > 0
    out = data.copy()
    out[end[~last]] = 32
    sizes = np.bincount(row, stop - start, n_rows).astype(np.int64)
    return out[take], np.concatenate(([0], np.cumsum(sizes)))


def scan_batch(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(n_words, runs, collapsed text) of whole texts."""
    counts, lists, outs = [], [], []
    for first, end, data, offsets in tokens.pieces(texts):
        words, found = find_runs(data, offsets)
        counts.append(np.bincount(words[2], minlength=end - first).astype(np.int64))
        per_row = np.bincount(found[0], minlength=end - first)
        lists.append(pa.ListArray.from_arrays(
            np.concatenate(([0], np.cumsum(per_row))).astype(np.int32),
            pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in found[1:]], ["start", "length", "period"])))
        body, cuts = collapsed(data, end - first, words, found)
        outs.append(pa.LargeStringArray.from_buffers(end - first, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(body)))
    return pa.array(np.concatenate(counts)), pa.concat_arrays(lists), pa.concat_arrays(outs).cast(pa.string())


# ---- on Spark -----------------------------------------------------------------------------------

def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs (by start, then period) and the collapsed text.

    Words are runs of anything but space and 0x09 to 0x0D, numbered from 0.
    ``collapsed`` holds the words that no run contains after its first
    period, joined by one space.  Null and empty texts have no words, no runs
    and an empty collapsed text.  Rows are judged one by one, so repeated
    rows and ids get equal results, null ids too; no order of rows matters.
    Runs never tie on start and length.  An empty table gives an empty
    result; further columns are not read.  A text is worked on as a whole:
    the memory of its task is about 40 bytes a word and 200 to 400 bytes for
    each word that recurs.  Words are told apart by 64-bit hashes.
    """
    schema = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.lit(0).cast("long").alias("n_words"),
                         F.lit(None).cast(RUNS).alias("runs"), F.lit("").alias("collapsed")).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, found, text = scan_batch(batch["text"])
                yield pa.RecordBatch.from_arrays([batch["doc_id"], n, found, text],
                                                 ["doc_id", "n_words", "runs", "collapsed"])
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return in_batches(rows).mapInArrow(scan, schema)
