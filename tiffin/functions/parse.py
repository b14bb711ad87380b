"""Column-level cleaning expressions (all JVM-side, ANSI-safe).

Spark 4 runs with ANSI on: a plain ``cast('' as double)`` raises.  Every
dirty text field is therefore parsed with ``try_cast`` and friends, so a bad
value becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed value: the rating pattern, one digit, a dot, one digit ("4.1/5").
RATING_PATTERN = r"(\d\.\d)"
# Fixed value: separator of a multi-valued list field ("North Indian, Chinese").
LIST_SPLIT_PATTERN = r",\s*"


def trimmed(c) -> Column:
    """Strip spaces at both ends."""
    return F.trim(_c(c))


def primary_value(c, sep: str = ",") -> Column:
    """First element of a delimited list, trimmed; NULL stays NULL."""
    return F.trim(F.split(_c(c), sep).getItem(0))


def rating(c) -> Column:
    """T4: "4.1/5" -> 4.1; "NEW", "-", "" and NULL -> NULL."""
    return F.regexp_extract(_c(c), RATING_PATTERN, 1).try_cast("double")


def int_of(c) -> Column:
    """T5: text (possibly "4.0") -> int; anything else -> NULL."""
    return _c(c).try_cast("double").try_cast("int")


def yes_no(c) -> Column:
    """T6: "Yes" -> true, other text -> false, NULL -> NULL."""
    return _c(c) == F.lit("Yes")


def cost(c) -> Column:
    """T7: "1,200" -> 1200.0 (thousands separators dropped)."""
    return F.regexp_replace(_c(c), ",", "").try_cast("double")


def hour_of(c) -> Column:
    """T13: "HH:MM" -> HH as int."""
    return F.split(_c(c), ":").getItem(0).try_cast("int")


def is_blank(c) -> Column:
    """NULL or empty text (the "missing" test used by the validation rules)."""
    return _c(c).isNull() | (_c(c) == F.lit(""))


def coerce(df: DataFrame, name: str, target: str) -> Column:
    """Type-aware cast of column ``name`` to ``target``.

    Text is parsed leniently (``try_cast``; ints via double so "4.0" works;
    dates via ``try_to_date``); already-typed columns are cast directly.
    Decided at plan-build time from the schema, so no runtime branching.
    """
    dtype = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(dtype, T.StringType):
        if target == "date":
            return F.try_to_date(col)
        if target in ("int", "bigint", "long"):
            return col.try_cast("double").try_cast(target)
        return col.try_cast(target)
    if target == "date" and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(col)
    return col.cast(target)
