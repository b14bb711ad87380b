"""Stringified review lists -> review rows.

The raw field is a Python list literal of ``(rating text, review text)``
pairs.  A list of pairs of plain strings - either quote, the usual escapes -
is taken apart by column expressions.  Only what ``PLAIN_LIST`` doesn't accept
(prefixes, rare escapes, joined or nested members, text that is no literal)
goes to Python: an Arrow-batched function with the whole grammar turns a field
into an array of pairs of strings, or null.  Both ways give the same pairs.
The rating's number, the marker and trimming are column expressions.

Semantics (per field):
* NULL or "" -> empty list (no review rows, not rejected);
* not a literal, or not a list of pairs -> NULL (quarantined as
  ``unparseable_reviews_list``);
* rating = first number in the rating text, else NULL;
* text = the text with its first ``RATED`` removed, then whitespace-stripped;
* a rating or text that is no string counts as empty.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAIRS = T.ArrayType(T.StructType([T.StructField("rating", T.StringType()), T.StructField("body", T.StringType())]))
# The number pattern of a rating, the marker removed from text, the reject reason,
# and white space as the parser's language strips it.
NUMBER = r"(\d+(?:\.\d+)?)"
RATED_MARKER = "RATED"
UNPARSEABLE = "unparseable_reviews_list"
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"

# The part of the grammar that needs no Python.  All loops are possessive: they run in constant stack.
_GAP = r"[ \t\n]*+"
_ESCAPE = r"\\(?:[\\'\"nrt]|x[0-9a-fA-F]{2})"
_STRING = "|".join(rf"{q}[^{q}\\\n\r\x00]*+(?:{_ESCAPE}[^{q}\\\n\r\x00]*+)*+{q}" for q in "'\"")
PLAIN_PAIR = rf"\({_GAP}({_STRING}){_GAP},{_GAP}({_STRING}){_GAP},?+{_GAP}\)"
PLAIN_LIST = rf"^\[{_GAP}(?:{PLAIN_PAIR}{_GAP}(?:,{_GAP}{PLAIN_PAIR}{_GAP})*+,?+{_GAP})?+\]\z"


def is_plain(field: Column) -> Column:
    """Whether a field is empty or a list that needs no Python."""
    return (field == "") | field.rlike(PLAIN_LIST)


def _unescaped(text: Column) -> Column:
    """The text of a plain string between its quotes."""
    def piece(p: Column) -> Column:
        for c, meant in (("n", "\n"), ("r", "\r"), ("t", "\t"), ("'", "'"), ('"', '"')):
            p = F.replace(p, F.lit("\\" + c), F.lit(meant))
        # what follows \x starts with two hex digits
        code = lambda x: F.char(F.conv(x.substr(1, 2), 16, 10).cast("long"))
        return F.array_join(F.transform(F.split(p, r"\\x"), lambda x, i: F.when(i == 0, x).otherwise(
            F.concat(code(x), x.substr(F.lit(3), F.length(x))))), "")
    # between pairs of backslashes each backslash starts an escape
    pieces = F.transform(F.split(text, r"\\\\"), piece)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(text)


def plain_pairs(field: Column) -> Column:
    """The pairs of a field that ``is_plain``."""
    def member(pair: Column, nr: int) -> Column:
        quoted = F.regexp_extract(pair, PLAIN_PAIR, nr)
        return _unescaped(quoted.substr(F.lit(2), F.length(quoted) - 2))
    return F.transform(F.regexp_extract_all(field, F.lit(PLAIN_PAIR), F.lit(0)),
                       lambda p: F.struct(member(p, 1).alias("rating"), member(p, 2).alias("body")))


def literal_pairs(field: str) -> list[tuple[str, str]] | None:
    """The pairs of a list literal, members that are no string as empty strings; None if it is none."""
    sequence = (list, tuple)
    try:
        found = ast.literal_eval(field)
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        return None
    if not isinstance(found, sequence) or any(not isinstance(p, sequence) or len(p) != 2 for p in found):
        return None
    return [tuple(x if isinstance(x, str) else "" for x in p) for p in found]


@F.pandas_udf(PAIRS)
def _pairs(fields: pd.Series) -> pd.Series:
    parsed = [[] if not f else literal_pairs(f) for f in fields]
    return pd.Series([p if p is None else [{"rating": a, "body": b} for a, b in p] for p in parsed], dtype=object)


# Non-deterministic for the optimizer, so that a filter and an explode share one call.
pairs = _pairs.asNondeterministic()


def rating_of(text: Column) -> Column:
    return F.regexp_extract(text, NUMBER, 1).try_cast("double")


def body_of(text: Column) -> Column:
    at = F.instr(text, RATED_MARKER)
    rest = F.when(at > 0, F.concat(text.substr(F.lit(1), at - 1),
                                   text.substr(at + len(RATED_MARKER), F.length(text)))).otherwise(text)
    return F.regexp_replace(rest, f"^{SPACE}+|{SPACE}+$", "")


def with_parsed(df: DataFrame, col: str = "reviews_list") -> DataFrame:
    """(restaurant_id, parsed): the pairs of each field; null if it is no list of pairs."""
    field = F.coalesce(F.col(col), F.lit(""))
    rows = df.select("restaurant_id", field.alias("field"), is_plain(field).alias("plain"))
    # Python gets nulls for the plain ones
    rest = pairs(F.when(~F.col("plain"), F.col("field")))
    return rows.select("restaurant_id", F.when(F.col("plain"), plain_pairs(F.col("field"))).otherwise(rest).alias("parsed"))


def parsed_reviews(parsed: DataFrame) -> DataFrame:
    """One row per review, with its position in the list (tie-breaker)."""
    rows = parsed.select("restaurant_id", F.posexplode("parsed").alias("review_pos", "r"))
    return rows.select("restaurant_id", "review_pos", rating_of(F.col("r.rating")).alias("review_rating"),
                       body_of(F.col("r.body")).alias("review_text"))


def rejected_reviews(parsed: DataFrame) -> DataFrame:
    """Restaurants whose list could not be parsed."""
    return (parsed.where(F.col("parsed").isNull())
            .select("restaurant_id", F.lit(UNPARSEABLE).alias("reject_reason")))
