"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn::

    ### User: text</turn>
    ### Assistant: text</turn>

and read back by a deterministic parser, which knows nothing but the text: it
cuts at ``</turn>`` and a line feed, then at ``### ``; a header ends at its
first colon and space; a backslash stands for the character behind it.  What
the parser recovers is compared to the source.  A turn whose text holds such
strings comes back as something else and is rendered again with more escaped,
until it comes back identical:

0. nothing is escaped;
1. control strings get a backslash in their middle;
2. backslashes are doubled first, which holds for every text.

The assembled conversation is parsed once more as a whole and compared turn by
turn; a difference fails the job rather than reaching a training set.

Column expressions only: turns are rendered and compared as rows, before they
are brought together by conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiffin.llm.common import text_or_empty

OPEN, CLOSE, COLON = "### ", "</turn>", ": "
#: How a turn ends; the parser cuts here.
END = CLOSE + "\n"
#: Roles and their headers; any other role follows an equals sign, escaped.
HEADERS = {"system": "System", "user": "User", "assistant": "Assistant"}
OTHER = "="
#: Control strings and their escaped forms, which hold none of them.
ESCAPES = [(OPEN, "##\\# "), (CLOSE, "<\\/turn>")]
ROUNDS = 3


def escape(text: Column, level: int) -> Column:
    """The text as a round renders it; ``unescape`` gives it back for every text at the last level."""
    if level > 1:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    if level > 0:
        text = reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def header(role: Column) -> Column:
    """A role's header: never a control string, never a colon and space."""
    other = F.concat(F.lit(OTHER), F.replace(escape(role, ROUNDS - 1), F.lit(COLON), F.lit(":\\ ")))
    return reduce(lambda out, r: F.when(role == r, HEADERS[r]).otherwise(out), HEADERS, other)


def role_of(head: Column) -> Column:
    own = unescape(F.substring(head, len(OTHER) + 1, 1 << 30))
    return reduce(lambda out, r: F.when(head == HEADERS[r], r).otherwise(out), HEADERS, own)


def render(role: Column, text: Column, level: int) -> Column:
    return F.concat(F.lit(OPEN), header(role), F.lit(COLON), escape(text, level), F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns that the grammar finds in a text, in order: array of (role, text).

    Between two turns there may be anything that opens none.  A turn that
    nothing closes ends with the text or where the next one opens.
    """
    def turn(part: Column) -> Column:
        at = F.instr(part, COLON)
        return F.struct(role_of(F.substring(part, F.lit(1), at - 1)).alias("role"),
                        unescape(F.substring(part, at + len(COLON), F.lit(1 << 30))).alias("text"))

    def opened(piece: Column) -> Column:
        parts = F.split(piece, OPEN, -1)
        return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    pieces = F.transform(F.split(formatted, END, -1), opened)
    return F.transform(F.flatten(pieces), turn)


def conflicts(formatted: Column) -> Column:
    """Control strings that a rendered turn holds beside its own two."""
    def count(mark: str) -> Column:
        return F.size(F.split(formatted, mark, -1)) - 2
    return count(OPEN) + count(CLOSE)


def rendered_turn(role: Column, text: Column) -> Column:
    """The turn by the first round that the parser reads back as it was, without a control string left in it."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    out = F.raise_error(F.lit("a turn can't be read back"))
    for level in reversed(range(ROUNDS)):
        tried = render(role, text, level)
        out = F.when((conflicts(tried) == 0) & (parse(tried) == source), tried).otherwise(out)
    return out


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, spans, turns.

    ``formatted`` is the rendered conversation; ``spans`` holds per turn
    (from, to, loss): the code points [from, to) of its text in
    ``formatted`` and whether they are learned, which those of the role
    ``learn`` are.  ``turns`` is what the parser recovers from ``formatted``:
    (role, text) in order, equal to the source or the job fails.

    Rows are ordered by turn, nulls first, and equal turns by role, then
    text; repeated rows are turns of their own.  Null roles and texts count as
    empty.  The rows without an id are one conversation.  An empty text makes
    an empty span.  An empty table gives an empty result; further columns are
    not read.  A conversation is one value: its turns meet in one task, and
    together they must stay below the 2 GB of a string.
    """
    rows = turns.select(F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                        text_or_empty(role_col).alias("role"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumn("piece", rendered_turn(F.col("role"), F.col("text")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.select("conv_id", "role", "text", "piece", F.row_number().over(order).alias("nr"),
                       F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    begin = F.coalesce("before", F.lit(0))
    text_from = begin + len(OPEN + COLON) + F.length(header(F.col("role")))
    text_to = begin + F.length("piece") - len(END)
    found = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "nr", "piece", text_from.alias("from"), text_to.alias("to"), "role", "text"))).alias("t"))
    found = found.select("conv_id", F.array_join("t.piece", "").alias("formatted"), F.transform("t", lambda t: F.struct(
        t["from"].cast("long").alias("from"), t["to"].cast("long").alias("to"), (t["role"] == learn).alias("loss"))).alias("spans"),
        F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))
    found = found.withColumn("turns", parse(F.col("formatted")))
    return found.select("conv_id", "formatted", "spans", F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(
        F.raise_error(F.lit("a conversation can't be read back"))).alias("turns"))


def learned_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, read from the formatted text by its spans."""
    pieces = F.split(formatted, END, -1)

    def text(span: Column, i: Column) -> Column:
        begin = F.when(i > 0, F.get(spans, i - 1)["to"] + len(END)).otherwise(F.lit(0))
        return unescape(F.substring(F.get(pieces, i), (span["from"] - begin + 1).cast("int"),
                                    (span["to"] - span["from"]).cast("int")))
    masked = F.transform(spans, lambda s, i: F.when(s["loss"], text(s, i)).otherwise(F.lit("")))
    return F.array_join(masked, "")
