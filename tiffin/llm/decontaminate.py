"""Benchmark decontamination over a distributed positional inverted index.

The index stores postings (term, document, position) of the training texts,
dealt by term; a term with very many is split over several files.  Test passages are windows of consecutive item words.  For
each window the two terms that are rarest in the corpus are looked up, their
posting lists adjusted by the terms' offsets and intersected: both terms must
meet on the same diagonal (document position minus item position) of the same
document.  What survives is compared word by word with the text, which makes
the phrase matches exact.

Only terms that a lookup needs are indexed; the choice of terms comes from
counts over the whole corpus.  Terms are 64-bit hashes of words; a chance
collision costs a comparison, never a wrong match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tiffin.llm import tokens
from tiffin.llm.common import in_batches, staged, text_or_empty

WINDOW = 10
#: Bits of the filters sent to all tasks: 512 KB each, whatever the data.
FILTER_BITS = 22


# ---- words --------------------------------------------------------------------------------------

def _split(data: bytes, table: bytes) -> list[bytes]:
    return data.translate(table).split()


def _space_table() -> bytes:
    """Translates word bytes to themselves, lower-cased, and all others to a space."""
    classes, values = tokens.word_table()
    return bytes(np.where(classes > 0, values, 32).astype(np.uint8))


def hashed_words(batches: Iterator[pa.RecordBatch], col: int) -> Iterator[tuple]:
    """(batch, first row, row of each word, position in its text, hash) piece by piece."""
    classes, values = tokens.word_table()
    for batch in batches:
        for first, end, data, offsets in tokens.pieces(batch.column(col)):
            start, length, row = tokens.token_spans(data, offsets, classes)
            terms = tokens.token_hashes(data, values, start, length).view(np.int64)
            begin = np.searchsorted(row, np.arange(end - first))
            yield batch, first, row, np.arange(len(row)) - begin[row], terms


# ---- fixed-size filters -------------------------------------------------------------------------

def _slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def hash_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit array of 2**bits bits with the slots of a one-column frame of 64-bit hashes set.

    Its size is fixed: at most 2**bits / 64 rows come to the driver, as many
    words go to the tasks.  A set that fills it lets everything pass, which
    costs time and no result.
    """
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.unique(_slot(batch.column(0).to_numpy(), bits))
            word = (s >> np.uint64(6)).astype(np.int64)
            bit = np.uint64(1) << (s & np.uint64(63))
            cut = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else []
            yield pa.RecordBatch.from_pydict({
                "word": word[cut] if len(word) else word,
                "bits": (np.bitwise_or.reduceat(bit, cut) if len(word) else bit).view(np.int64)})
    rows = (in_batches(hashes).mapInArrow(slots, "word long, bits long")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).collect())
    out = np.zeros(1 << (bits - 6), np.int64)
    for r in rows:
        out[r["word"]] = r["bits"]
    return out.view(np.uint64)


def in_filter(found: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = int(found.size * 64).bit_length() - 1
    s = _slot(h, bits)
    return (found[s >> np.uint64(6)] >> (s & np.uint64(63))) & np.uint64(1) == 1


# ---- the index ----------------------------------------------------------------------------------

def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("check"), text.alias("text"))


def term_counts(docs: DataFrame, wanted: np.ndarray | None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """(term, n): occurrences in the corpus of all terms, or of those that pass the filter ``wanted``."""
    share = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, _, terms in hashed_words(batches, 0):
            if share is not None:
                terms = terms[in_filter(share.value, terms)]
            term, n = np.unique(terms, return_counts=True)
            yield pa.RecordBatch.from_pydict({"term": term, "n": n.astype(np.int64)})
    rows = in_batches(docs.select(text_or_empty(text_col).alias("text"))).mapInArrow(count, "term long, n long")
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def postings(docs: DataFrame, wanted: np.ndarray | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The index as a frame (term, doc_id, check, pos); all terms, or those that pass ``wanted``.

    ``check`` is a hash of the text: it tells rows apart that share a doc_id.
    """
    rows = _keyed(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    share = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, row, pos, terms in hashed_words(batches, 2):
            if share is not None:
                own = in_filter(share.value, terms)
                row, pos, terms = row[own], pos[own], terms[own]
            at = pa.array(row + first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(terms), batch.column(0).take(at), batch.column(1).take(at), pa.array(pos.astype(np.int32))],
                names=["term", "doc_id", "check", "pos"])
    return in_batches(rows).mapInArrow(post, f"term long, doc_id {kind}, check long, pos int")


# ---- test passages ------------------------------------------------------------------------------

def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, item, pos, term) of the distinct items; ``item`` is a key of id and text."""
    rows = (items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"), text_or_empty(text_col).alias("text"))
            .distinct().select("item_id", F.xxhash64("item_id", "text").alias("item"), "text"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, first, row, pos, terms in hashed_words(batches, 2):
            at = pa.array(row + first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(pos.astype(np.int32)), pa.array(terms)],
                names=["item_id", "item", "pos", "term"])
    return in_batches(rows).mapInArrow(part, "item_id string, item long, pos int, term long")


def window_anchors(counts: list[int], width: int) -> list[tuple[int, int]]:
    """Per window of an item the places of its two rarest terms (in order; one place if it has one word).

    ``counts`` are the corpus counts of the item's words; a window with a
    term that the corpus lacks occurs nowhere and is left out.
    """
    n, out = len(counts), set()
    width = min(width, n)
    for s in range(n - width + 1 if n else 0):
        order = sorted(range(s, s + width), key=lambda i: (counts[i], i))
        if counts[order[0]] > 0:
            out.add(tuple(sorted((order[0], order[min(1, width - 1)]))))
    return sorted(out)


def lookups(terms: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """(item, item_id, p, q, term_p, term_q): for each item the pairs of places to look up."""
    counted = (terms.join(counts, "term", "left")
               .groupBy("item", "item_id")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "term", F.coalesce("n", F.lit(0)).alias("n")))).alias("w")))
    rows = counted.select("item", "item_id", F.col("w.term").alias("term"), F.col("w.n").alias("n"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(r["item"], r["item_id"], p, q, r["term"][p], r["term"][q])
                   for r in batch.to_pylist() for p, q in window_anchors(r["n"], width)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out) if out else [[]] * 6,
                [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()])],
                names=["item", "item_id", "p", "q", "term_p", "term_q"])
    return in_batches(rows).mapInArrow(part, "item long, item_id string, p int, q int, term_p long, term_q long")


def diagonals(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, check, item, delta) on which both terms of a lookup meet."""
    places = (wanted.select("item", F.col("p").alias("place"), F.col("term_p").alias("term"))
              .union(wanted.select("item", "q", "term_q")).distinct())
    seen = (index.join(places, "term")
            .select("doc_id", "check", "item", (F.col("pos") - F.col("place")).alias("delta"), "place"))
    # the adjusted lists of an item meet by diagonal; a diagonal holds a place of the item at most once
    met = seen.groupBy("doc_id", "check", "item", "delta").agg(F.collect_set("place").alias("places"))
    pairs = wanted.groupBy(F.col("item").alias("of")).agg(F.collect_set(F.struct("p", "q")).alias("pairs"))
    both = F.exists("pairs", lambda x: F.array_contains("places", x["p"]) & F.array_contains("places", x["q"]))
    return met.join(pairs, F.col("item") == F.col("of")).where(both).select("doc_id", "check", "item", "delta")


# ---- comparison with the texts ------------------------------------------------------------------

def matched_spans(doc: list[bytes], item: list[bytes], delta: int, width: int) -> list[tuple[int, int]]:
    """Stretches [start, end) of the document equal to the item on one diagonal, as long as a window at least."""
    width = min(width, len(item))
    lo, hi = max(0, -delta), min(len(item), len(doc) - delta)
    spans, run = [], lo
    for i in range(lo, hi + 1):
        if i == hi or doc[i + delta] != item[i]:
            if i - run >= width > 0:
                spans.append((run + delta, i + delta))
            run = i + 1
    return spans


def phrase_matches(docs: DataFrame, items: DataFrame, width: int = WINDOW, id_col: str = "doc_id",
                   text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, matches array<struct<item_id, start, end>>.

    A match is a longest stretch of document words [start, end) equal to item
    words, of at least ``width`` words, or of the whole item if that has
    fewer.  Null or wordless texts and items match nothing.
    """
    terms = staged(item_terms(items, item_id_col, item_text_col), "bench-terms")
    counts = term_counts(docs, hash_filter(terms.select("term")), id_col, text_col)
    wanted = staged(lookups(terms, counts, width), "bench-lookups")
    both = wanted.select("term_p").union(wanted.select("term_q"))
    index = staged(postings(docs, hash_filter(both), id_col, text_col).hint("rebalance", "term"), "bench-index")
    found = staged(diagonals(index, wanted), "bench-diagonals")
    found_docs = docs.sparkSession.sparkContext.broadcast(hash_filter(found.select("check")))
    texts = items.select(F.col(f"`{item_id_col}`").cast("string").alias("item_id"),
                         text_or_empty(item_text_col).alias("item_text")).distinct()
    texts = texts.select(F.xxhash64("item_id", "item_text").alias("i"), "item_id", "item_text")
    # the few items that a document may hold travel with it, each once
    per_item = (found.groupBy("doc_id", "check", "item").agg(F.collect_list("delta").alias("deltas"))
                .join(texts, F.col("item") == F.col("i")))
    per_doc = per_item.groupBy(F.col("doc_id").alias("d"), F.col("check").alias("c")).agg(
        F.collect_list(F.struct("item_id", "item_text", "deltas")).alias("found"))
    rows = _keyed(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words of each text; the text itself only where something may be found."""
        classes, _ = tokens.word_table()
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            for first, end, data, offsets in tokens.pieces(batch.column(2)):
                row = tokens.token_spans(data, offsets, classes)[2]
                n[first:end] = np.bincount(row, minlength=end - first)
            check = batch.column(1).to_numpy()
            need = pa.array(in_filter(found_docs.value, check))
            text = pc.if_else(need, batch.column(2), pa.scalar(None, batch.column(2).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n), text],
                                             names=["doc_id", "check", "n_words", "text"])
    rows = in_batches(rows).mapInArrow(counted, f"doc_id {kind}, check long, n_words long, text string")
    joined = rows.join(per_doc.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("check") == F.col("c")), "left")
    joined = joined.select("doc_id", "n_words", F.when(F.col("found").isNotNull(), F.col("text")).alias("text"), "found")
    result = f"doc_id {kind}, n_words long, matches array<struct<item_id:string,start:int,end:int>>"
    schema = to_arrow_schema(_empty(docs.sparkSession, result).schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _space_table()
        for batch in batches:
            out = []
            for text, found in zip(batch.column(2), batch.column(3)):
                matches = []
                if found.is_valid and text.is_valid:
                    doc = _split(text.as_py().encode("utf-8", "surrogatepass"), table)
                    for f in found.as_py():
                        item = _split(f["item_text"].encode("utf-8", "surrogatepass"), table)
                        for delta in f["deltas"]:
                            matches += [{"item_id": f["item_id"], "start": a, "end": b}
                                        for a, b in matched_spans(doc, item, delta, width)]
                out.append(matches)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, schema.field("matches").type)], schema=schema)
    return in_batches(joined).mapInArrow(compare, result)


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def proximity_matches(docs: DataFrame, phrases: DataFrame, within: int, id_col: str = "doc_id",
                      text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start, end): the stretches of at most ``within`` words with all of an item's distinct terms.

    From the same index: postings of the item's terms by document, in order
    of position; for each end the shortest stretch is given once.  A stretch
    is found by its terms' 64-bit hashes.
    """
    terms = staged(item_terms(phrases, item_id_col, item_text_col).select("item_id", "item", "term").distinct(),
                   "near-terms")
    counts = term_counts(docs, hash_filter(terms.select("term")), id_col, text_col)
    sized = terms.groupBy("item", "item_id").agg(F.count(F.lit(1)).alias("n_terms"))
    # the rarest term first: documents without it hold no match
    rarest = (terms.join(counts, "term").groupBy("item")
              .agg(F.min_by("term", F.struct("n", "term")).alias("term")))
    index = staged(postings(docs, hash_filter(terms.select("term")), id_col, text_col).hint("rebalance", "term"), "near-index")
    having = index.join(rarest, "term").select("doc_id", "check", "item").distinct()
    i, t = index.alias("i"), terms.alias("t")
    hits = i.join(t, "term").select("doc_id", "check", "item", "term", "pos")
    h, g = hits.alias("h"), having.alias("g")
    hits = h.join(g, F.expr("h.doc_id <=> g.doc_id AND h.check = g.check AND h.item = g.item"), "left_semi")
    # of each hit: for all terms the last place before it, from a range of positions
    hits = hits.withColumn("block", F.floor(F.col("pos") / within))
    earlier = hits.withColumn("block", F.explode(F.array("block", F.col("block") + 1)))
    near = hits.alias("a").join(earlier.alias("b"), F.expr(
        "a.doc_id <=> b.doc_id AND a.check = b.check AND a.item = b.item AND a.block = b.block "
        f"AND b.pos BETWEEN a.pos - {within - 1} AND a.pos"))
    last = near.groupBy("a.doc_id", "a.check", "a.item", "a.pos", "b.term").agg(F.max("b.pos").alias("at"))
    spans = (last.groupBy("doc_id", "check", "item", "pos")
             .agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
             .join(sized, "item").where("n = n_terms"))
    return spans.select("doc_id", "item_id", "start", (F.col("pos") + 1).alias("end")).distinct()


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, n_hit, n_items, item_ids (sorted strings), contaminated, matches.

    A document word is hit if it lies in an occurrence of a window of
    ``width`` item words (of all words of a shorter item).  Null texts have
    no words; null item ids count as a key of their own, named by the empty
    string; repeated rows get equal results; other columns are not read.
    """
    found = phrase_matches(docs, items, width, id_col, text_col, item_id_col, item_text_col)
    # total length of the union of [start, end), by one pass over the sorted stretches
    ordered = F.sort_array(F.transform("matches", lambda m: F.struct(m["start"].alias("s"), m["end"].alias("e"))))
    union = F.aggregate(ordered, F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")), lambda acc, m: F.struct(
        (acc["n"] + F.greatest(F.lit(0), m["e"] - F.greatest(acc["upto"], m["s"]))).alias("n"),
        F.greatest(acc["upto"], m["e"]).alias("upto")))
    ids = F.array_sort(F.array_distinct(F.transform("matches", lambda m: F.coalesce(m["item_id"], F.lit("")))))
    return found.select("doc_id", "n_words", union["n"].cast("long").alias("n_hit"), ids.alias("item_ids"), "matches"
                        ).select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                                 "item_ids", (F.col("n_hit") > 0).alias("contaminated"), "matches")
