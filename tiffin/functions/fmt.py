"""Report formatting (Q31) and column labels (Q32).

Formatting is decided per column at plan-build time from the schema and
the column name, and applied with JVM string functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name fragments that mark money columns, the currency sign, the
# placeholder for missing values, and the money threshold for whole-unit display.
MONEY_HINTS = ("revenue", "spend", "order_value")
CURRENCY = "₹"
MISSING = "—"
MONEY_WHOLE_FROM = 1000


def label_of(name: str) -> str:
    """Q32: "avg_order_value" -> "Avg Order Value"."""
    return name.replace("_", " ").title()


def format_value(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    lname = name.lower()
    if isinstance(dtype, T.StringType):
        return F.coalesce(c, F.lit(MISSING))
    if isinstance(dtype, T.BooleanType):
        return F.when(c.isNull(), F.lit(MISSING)).when(c, F.lit("Yes")).otherwise(F.lit("No"))
    if not isinstance(dtype, T.NumericType):
        return F.coalesce(c.cast("string"), F.lit(MISSING))
    if lname.endswith("_enabled"):
        yes_no = F.when(c == 1, F.lit("Yes")).when(c == 0, F.lit("No"))
    else:
        yes_no = None
    money = any(h in lname for h in MONEY_HINTS)
    whole = F.format_number(c, 0)
    frac = F.format_number(c, 2)
    is_whole = c == F.floor(c)
    out = F.when(c.isNull() | F.isnan(c.cast("double")), F.lit(MISSING))
    if yes_no is not None:
        out = out.when(c.isin(0, 1), yes_no)
    if money:
        out = out.when(F.abs(c) >= MONEY_WHOLE_FROM, F.concat(F.lit(CURRENCY), whole))
    return out.when(is_whole, whole).otherwise(frac)


def format_report(df: DataFrame) -> DataFrame:
    """Q31 + Q32: every value formatted as display text, columns labelled."""
    return df.select(*[format_value(df, c).alias(label_of(c)) for c in df.columns])
