"""CSV folders whose files differ: headers by file, malformed records kept.

A folder collects files of many hands: columns in another order, one more or
one less, a value over several lines here and there, a record cut short.  One
pass over the lines finds each file's header and how its quotes are balanced;
files that agree in that are read together, by name, and the groups united.
A file without a quote left open at any line's end is split into many tasks;
only files with values over several lines are read by one task each.

A record that doesn't fit its header is kept with a reason instead of being
padded or cut: ``too_few_fields``, ``too_many_fields``, or ``unclosed_quote``
for the last record of a file whose quotes don't add up (it holds all the
lines that the open quote swallowed).
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOO_FEW, TOO_MANY, UNCLOSED = "too_few_fields", "too_many_fields", "unclosed_quote"
MALFORMED, RAW = "malformed", "raw_record"
# What a typed scan of the raw files takes for missing.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
             "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def file_layouts(spark: SparkSession, path: str) -> DataFrame:
    """(file, header, several, open): header line, whether values run over lines, whether a quote never closes.

    One row per file that has a line; empty files have none.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"), "value",
                                         F.monotonically_increasing_id().alias("nr"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    filled = F.when(F.trim("value") != "", F.struct("block", "nr"))
    return lines.groupBy("file").agg(F.min_by("value", filled).alias("header"),
                                     F.max(quotes % 2 == 1).alias("several"),
                                     (F.sum(quotes) % 2 == 1).alias("open")).where(F.col("header").isNotNull())


def header_names(line: str) -> list[str]:
    """The column names of a header line; names that repeat or are blank get their position."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")]))):
        names.append(name if name and name not in names else f"{name}.{i}")
    return names


def scan_csv(spark: SparkSession, path: str, columns: Sequence[str], seq: str = "seq", missing: str = "error",
             na_tokens: Sequence[str] = ()) -> DataFrame:
    """All records of the files at ``path``: ``columns`` as text, ``seq``, ``malformed``, ``raw_record``.

    Each file's columns are taken by the names in its own header, further ones
    are left out.  A file that lacks one is an error, or with
    ``missing="null"`` has nulls there.  Empty files have no records, files
    with a header alone neither.  Quotes inside quotes are doubled; fields
    equal to one of ``na_tokens`` are null, unquoted empty ones always.
    ``seq`` = (file, block, pos) follows the order of the file.  ``malformed``
    is null, or why the record doesn't fit; its text is in ``raw_record`` then,
    and its fields are as far as they could be read.
    """
    groups: dict[tuple, list[str]] = defaultdict(list)
    for f in file_layouts(spark, path).collect():  # a row per file, as the driver's own listing has
        # the reader wants a path, and takes these characters for a pattern
        name = re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f["file"]))
        groups[tuple(header_names(f["header"])), f["several"], f["open"]].append(name)
    frames = []
    for (names, several, is_open), files in sorted(groups.items()):
        lacking = [c for c in columns if c not in names]
        if lacking and missing == "error":
            raise ValueError(f"{files[0]} has no column {', '.join(lacking)}")
        frames.append(_records(spark, files, names, columns, seq, several, is_open, na_tokens))
    return reduce(DataFrame.unionByName, frames) if frames else _none(spark, columns, seq)


def _records(spark: SparkSession, files: list[str], names: Sequence[str], columns: Sequence[str], seq: str, several: bool,
             is_open: bool, na_tokens: Sequence[str]) -> DataFrame:
    """The records of files with one header."""
    bad = "_bad_"
    while bad in names:
        bad += "_"
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, bad])
    rows = (spark.read.schema(schema).option("header", True).option("multiLine", several).option("escape", '"')
            .option("columnNameOfCorruptRecord", bad).option("columnPruning", False).csv(files))
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("pos"))

    def field(c: str) -> Column:
        value = F.col(f"`{c}`") if c in names else F.lit(None).cast("string")
        return F.when(~value.isin(*na_tokens), value) if na_tokens else value
    # always true: the reader refuses plans that need nothing but the record's text, as a count would
    read = F.length(F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))) >= 0
    reason = F.when(F.col(bad).isNotNull() & read, why(F.col(bad), len(names)))
    raw = F.col(bad)
    if is_open:
        # such a file is read by one task, so its rows are few enough for one window
        rows = rows.withColumn("_last_", F.max(place).over(Window.partitionBy(F.col("_metadata.file_path"))) == place)
        reason = F.when(F.col("_last_"), F.lit(UNCLOSED)).otherwise(reason)
        raw = F.when(F.col("_last_"), F.coalesce(raw, F.concat_ws(",", *[F.col(f"`{n}`") for n in names]))).otherwise(raw)
    return rows.select(*[field(c).alias(c) for c in columns], place.alias(seq), reason.alias(MALFORMED), raw.alias(RAW))


def why(record: Column, width: int) -> Column:
    """Why a record's text doesn't hold ``width`` fields."""
    bare = F.regexp_replace(record, '"[^"]*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (F.when(F.contains(bare, F.lit('"')), UNCLOSED).when(fields < width, TOO_FEW).otherwise(TOO_MANY))


def _none(spark: SparkSession, columns: Sequence[str], seq: str) -> DataFrame:
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([], f"{schema}, `{seq}` struct<file:string,block:long,pos:long>, {MALFORMED} string, {RAW} string")


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], seq: str = "seq", missing: str = "error",
             na_tokens: Sequence[str] = ()) -> DataFrame:
    """The records that fit their header, without the last two columns of ``scan_csv``."""
    rows = scan_csv(spark, path, columns, seq, missing, na_tokens)
    return rows.where(F.col(MALFORMED).isNull()).drop(MALFORMED, RAW)


def positions(malformed: DataFrame, rows: DataFrame, seq: str = "seq") -> DataFrame:
    """Malformed records as (file, record, malformed, raw_record); ``record`` counts from 1 within the file.

    ``rows`` is the whole landed scan; only its ``seq`` is read.
    """
    # records before a block, from the number of records of each block
    block = [F.col(f"`{seq}`.file").alias("file"), F.col(f"`{seq}`.block").alias("block")]
    held = rows.groupBy(*block).agg(F.min(f"`{seq}`.pos").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    bad = malformed.select(*block, F.col(f"`{seq}`.pos").alias("pos"), MALFORMED, RAW)
    return bad.join(held, ["file", "block"]).select(
        "file", (F.col("before") + F.col("pos") - F.col("first") + 1).alias("record"), MALFORMED, RAW)
