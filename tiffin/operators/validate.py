"""Rule-based validation with quarantine.

A rule is a (reason, condition) pair; a row whose condition is TRUE is
rejected with that reason.  A NULL condition passes (three-valued logic:
``NULL <= 0`` is not true), exactly like pandas' ``NaN <= 0 == False``.

Precedence:
* ``first`` — the first matching rule in list order names the reason
  (orders, items, payments, deliveries, customers);
* ``last`` — the last matching rule wins (restaurants: each rule overwrote
  the reason column in turn).

Duplicates (V7) are "any occurrence after the first in input order",
computed over *all* rows including rows already rejected for another
reason.  Input order is the explicit ``seq`` column; the first occurrence is
found with a partial aggregation and joined back; adaptive execution splits
the partition of a key that holds a third of the input.

Orphans (V8) are found with a join against the *valid* parent keys; a NULL
foreign key is an orphan.  Never ``NOT IN`` (the NULL trap).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.functions.parse import is_blank
from tiffin.operators.joins import lookup_join

REASON = "reject_reason"
# Fixed value: the rejection-rate threshold of the quality gate (strictly greater fails).
REJECTION_RATE_THRESHOLD = 0.02
# Reject reason codes, per entity in rule order.
MISSING_URL, MISSING_NAME, NEGATIVE_VOTES = "missing_url", "missing_name", "negative_votes"
MISSING_CUSTOMER_ID, DUPLICATE_CUSTOMER_ID = "missing_customer_id", "duplicate_customer_id"
NON_POSITIVE_ORDER_TOTAL, ORPHAN_CUSTOMER_ID = "non_positive_order_total", "orphan_customer_id"
ORPHAN_RESTAURANT_ID, DUPLICATE_ORDER_ID = "orphan_restaurant_id", "duplicate_order_id"
NEGATIVE_ITEM_PRICE, NON_POSITIVE_AMOUNT = "negative_item_price", "non_positive_amount"
NON_POSITIVE_DELIVERY_TIME, ORPHAN_ORDER_ID = "non_positive_delivery_time", "orphan_order_id"


@dataclass(frozen=True)
class Rule:
    reason: str
    condition: Column


def tag(df: DataFrame, rules: Sequence[Rule], precedence: str = "first",
        reason_col: str = REASON) -> DataFrame:
    """Add ``reason_col``: NULL for valid rows, else the winning rule's reason."""
    ordered = list(rules) if precedence == "first" else list(reversed(rules))
    expr = None
    for r in ordered:
        expr = F.when(r.condition, F.lit(r.reason)) if expr is None else expr.when(r.condition, F.lit(r.reason))
    return df.withColumn(reason_col, expr if expr is not None else F.lit(None).cast("string"))


def number(col: str) -> Column:
    """A field to compare with zero: typed or still text; text that is no number counts as missing."""
    return F.col(col).try_cast("double")


def row_place(df: DataFrame, seq: str = "seq") -> Column:
    """What orders the rows of one key; equal for rows that are equal throughout."""
    return F.struct(F.col(seq).alias("seq"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def duplicate_flag(df: DataFrame, key: str, seq: str = "seq", out: str = "_dup") -> DataFrame:
    """V7: TRUE for every occurrence of ``key`` after the first in ``seq`` order.

    NULL keys form one group (as pandas ``duplicated``).  Rows with equal
    ``seq`` are ordered by a hash of the whole row; rows equal throughout
    can't be told apart and share the flag.
    """
    placed = df.withColumn("_place", row_place(df, seq))
    first = placed.groupBy(key).agg(F.min("_place").alias("_first"))
    return (lookup_join(placed, first, [key], null_safe=True)
            .withColumn(out, F.col("_place") > F.col("_first")).drop("_place", "_first"))


def orphan_flag(df: DataFrame, fk: str, parent_keys: DataFrame, parent_key: str, out: str) -> DataFrame:
    """V8: TRUE when ``fk`` is NULL or absent from ``parent_keys[parent_key]``."""
    parents = (parent_keys.select(F.col(parent_key).alias(fk)).where(F.col(fk).isNotNull())
               .distinct().withColumn(f"_found_{fk}", F.lit(True)))
    joined = lookup_join(df, parents, [fk])
    return joined.withColumn(out, F.col(f"_found_{fk}").isNull()).drop(f"_found_{fk}")


def valid(tagged: DataFrame, reason_col: str = REASON) -> DataFrame:
    """Valid side (reason dropped)."""
    return tagged.where(F.col(reason_col).isNull()).drop(reason_col)


def rejected(tagged: DataFrame, reason_col: str = REASON) -> DataFrame:
    """Quarantine side (with reason)."""
    return tagged.where(F.col(reason_col).isNotNull())


# ---------------------------------------------------------------- entity rules
def validate_restaurants(df: DataFrame) -> DataFrame:
    """V1: missing_url, missing_name, negative_votes; the last match wins."""
    rules = [
        Rule(MISSING_URL, is_blank("url")),
        Rule(MISSING_NAME, is_blank("name")),
        Rule(NEGATIVE_VOTES, number("votes") < 0),
    ]
    return tag(df, rules, "last")


def validate_customers(df: DataFrame, seq: str = "seq") -> DataFrame:
    """V2: missing_customer_id, then duplicate_customer_id."""
    d = duplicate_flag(df, "customer_id", seq)
    rules = [
        Rule(MISSING_CUSTOMER_ID, F.col("customer_id").isNull()),
        Rule(DUPLICATE_CUSTOMER_ID, F.col("_dup")),
    ]
    return tag(d, rules, "first").drop("_dup")


def validate_orders(df: DataFrame, valid_restaurants: DataFrame, valid_customers: DataFrame,
                    seq: str = "seq") -> DataFrame:
    """V3: non_positive_order_total, orphan_customer_id, orphan_restaurant_id,
    duplicate_order_id — the first match wins."""
    d = duplicate_flag(df, "order_id", seq)
    d = orphan_flag(d, "customer_id", valid_customers, "customer_id", "_orphan_c")
    d = orphan_flag(d, "restaurant_id", valid_restaurants, "restaurant_id", "_orphan_r")
    rules = [
        Rule(NON_POSITIVE_ORDER_TOTAL, number("order_total") <= 0),
        Rule(ORPHAN_CUSTOMER_ID, F.col("_orphan_c")),
        Rule(ORPHAN_RESTAURANT_ID, F.col("_orphan_r")),
        Rule(DUPLICATE_ORDER_ID, F.col("_dup")),
    ]
    return tag(d, rules, "first").drop("_dup", "_orphan_c", "_orphan_r")


def _child(df: DataFrame, valid_orders: DataFrame, reason: str, cond: Column) -> DataFrame:
    d = orphan_flag(df, "order_id", valid_orders, "order_id", "_orphan_o")
    return tag(d, [Rule(reason, cond), Rule(ORPHAN_ORDER_ID, F.col("_orphan_o"))], "first").drop("_orphan_o")


def child_rule(entity: str) -> tuple[str, Column]:
    """The rule of a child of orders that needs no parent: (reason, condition)."""
    if entity == "order_items":
        return NEGATIVE_ITEM_PRICE, number("item_price") < 0
    if entity == "payments":
        return NON_POSITIVE_AMOUNT, number("amount") <= 0
    return NON_POSITIVE_DELIVERY_TIME, number("delivery_time_minutes") <= 0


def validate_order_items(df: DataFrame, valid_orders: DataFrame) -> DataFrame:
    """V4: negative_item_price (< 0; zero allowed), orphan_order_id."""
    return _child(df, valid_orders, *child_rule("order_items"))


def validate_payments(df: DataFrame, valid_orders: DataFrame) -> DataFrame:
    """V5: non_positive_amount, orphan_order_id."""
    return _child(df, valid_orders, *child_rule("payments"))


def validate_deliveries(df: DataFrame, valid_orders: DataFrame) -> DataFrame:
    """V6: non_positive_delivery_time, orphan_order_id."""
    return _child(df, valid_orders, *child_rule("deliveries"))


# -------------------------------------------------------------------- cascade
ENTITIES = ("restaurants", "customers", "orders", "order_items", "payments", "deliveries")
CHILDREN = ("order_items", "payments", "deliveries")


def validate_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Orders against *valid* parents, children against *valid* orders.

    Returns the tagged frame per entity.  Callers that reuse the valid orders
    several times should persist or write them (the pipeline does).
    """
    r = validate_restaurants(raw["restaurants"])
    c = validate_customers(raw["customers"])
    o = validate_orders(raw["orders"], valid(r), valid(c))
    vo = valid(o).select("order_id")
    return {
        "restaurants": r,
        "customers": c,
        "orders": o,
        "order_items": validate_order_items(raw["order_items"], vo),
        "payments": validate_payments(raw["payments"], vo),
        "deliveries": validate_deliveries(raw["deliveries"], vo),
    }


# -------------------------------------------------------------------- reports
# Reports count outcomes, so they need no tagged rows: an entity's rows are counted by key and rule outcome first,
# and only these counts meet the parents.  A frame of outcomes has (order_id or nothing, reject_reason, rows).  Run logs
# want no reasons: they take the rows of orders and children by order.


def _rows() -> Column:
    return F.count(F.lit(1)).alias("rows")


def tagged_outcomes(tagged: DataFrame, *by: str, reason_col: str = REASON) -> DataFrame:
    """Outcomes of rows that are tagged already."""
    return tagged.groupBy(*by, F.col(reason_col).alias(REASON)).agg(_rows())


def customer_outcomes(df: DataFrame, seq: str = "seq") -> DataFrame:
    """V2 as counts: of each id the rows at the first place are valid, the others are duplicates."""
    placed = df.groupBy("customer_id", row_place(df, seq).alias("_place")).agg(_rows())
    per_id = placed.groupBy("customer_id").agg(F.sum("rows").alias("rows"), F.min_by("rows", "_place").alias("first"))
    named = F.col("customer_id").isNotNull()
    outcome = F.when(~named, F.array(F.struct(F.lit(MISSING_CUSTOMER_ID).alias(REASON), "rows"))).otherwise(F.array(
        F.struct(F.lit(None).cast("string").alias(REASON), F.col("first").alias("rows")),
        F.struct(F.lit(DUPLICATE_CUSTOMER_ID).alias(REASON), (F.col("rows") - F.col("first")).alias("rows"))))
    return (per_id.select(F.explode(outcome).alias("o")).select(f"o.{REASON}", "o.rows")
            .where("rows > 0").groupBy(REASON).agg(F.sum("rows").alias("rows")))


def child_outcomes(df: DataFrame, valid_orders: DataFrame, reason: str, condition: Column) -> DataFrame:
    """V4-V6 as counts by order."""
    counted = df.groupBy("order_id", F.coalesce(condition, F.lit(False)).alias("_bad")).agg(_rows())
    return _child(counted, valid_orders, reason, F.col("_bad")).drop("_bad")


def master_outcomes(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Outcomes of restaurants and customers."""
    return {"restaurants": tagged_outcomes(validate_restaurants(raw["restaurants"])),
            "customers": customer_outcomes(raw["customers"])}


def outcomes(raw: dict[str, DataFrame], tagged_orders: DataFrame, valid_orders: DataFrame) -> dict[str, DataFrame]:
    """Outcomes of all six entities; those of the children of orders by order_id."""
    return {**master_outcomes(raw), "orders": tagged_outcomes(tagged_orders),
            **{n: child_outcomes(raw[n], valid_orders, *child_rule(n)) for n in CHILDREN}}


def order_outcomes(raw: dict[str, DataFrame], tagged_orders: DataFrame, reason_col: str = REASON) -> DataFrame:
    """V3-V6 as (order_id, first_date, valid, rejected): the rows of an order and of its children, one row per order.

    ``tagged_orders`` has order_id, order_date and the reason.  Orders and
    children meet by order_id in one aggregation, partial per task, without a
    join or a sort.  A child that breaks no rule of its own is valid if its
    order has a valid row; without an order_id it is an orphan.
    """
    date = tagged_orders.schema["order_date"].dataType
    frames = [tagged_orders.select("order_id", F.col("order_date").alias("_date"), F.lit(True).alias("_order"),
                                   F.col(reason_col).isNull().alias("_good"))]
    for n in CHILDREN:
        bad = F.coalesce(child_rule(n)[1], F.lit(False))
        frames.append(raw[n].select("order_id", F.lit(None).cast(date).alias("_date"), F.lit(False).alias("_order"),
                                    (~bad).alias("_good")))
    order, good = F.col("_order"), F.col("_good")
    per_order = reduce(DataFrame.unionByName, frames).groupBy("order_id").agg(
        F.min("_date").alias("first_date"), F.count_if(order & good).alias("_valid"), F.count_if(order & ~good).alias("_rejected"),
        F.count_if(~order & good).alias("_passed"), F.count_if(~order & ~good).alias("_failed"))
    kept = F.when(F.col("order_id").isNotNull() & (F.col("_valid") > 0), F.col("_passed")).otherwise(F.lit(0))
    return per_order.select("order_id", "first_date", (F.col("_valid") + kept).alias("valid"),
                            (F.col("_rejected") + F.col("_failed") + F.col("_passed") - kept).alias("rejected"))


def rejection_report(counts: dict[str, DataFrame]) -> DataFrame:
    """(entity, valid, rejected, total, rejection_rate), one row per entity (rate 0 when empty).

    Takes outcomes, or tagged rows, which are counted first.
    """
    good = F.col(REASON).isNull()
    counts = {name: df if "rows" in df.columns else tagged_outcomes(df) for name, df in counts.items()}
    frames = [df.agg(F.coalesce(F.sum(F.when(good, F.col("rows"))), F.lit(0)).alias("valid"),
                     F.coalesce(F.sum(F.when(~good, F.col("rows"))), F.lit(0)).alias("rejected"))
              .select(F.lit(name).alias("entity"), "valid", "rejected") for name, df in counts.items()]
    total = F.col("valid") + F.col("rejected")
    return reduce(DataFrame.unionByName, frames).select(
        "entity", "valid", "rejected", total.alias("total"),
        F.coalesce(F.try_divide("rejected", total), F.lit(0.0)).cast("double").alias("rejection_rate"))


def reason_histogram(counts: dict[str, DataFrame]) -> DataFrame:
    """(entity, reject_reason, rows) over the quarantined rows."""
    return reduce(DataFrame.unionByName, [
        df.where(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.sum("rows").alias("rows"))
        .select(F.lit(name).alias("entity"), F.col(REASON).alias("reject_reason"), "rows") for name, df in counts.items()])


def rejection_summary(report: DataFrame, threshold: float = REJECTION_RATE_THRESHOLD) -> DataFrame:
    """V13 + V14: worst entity rate, overall rate, and whether the gate fails.

    The gate looks at the *worst single entity* (> threshold fails) while the
    logged overall rate is total rejected / total rows.
    """
    agg = report.agg(F.max("rejection_rate").alias("worst_rate"),
                     F.sum("valid").alias("total_valid"),
                     F.sum("rejected").alias("total_rejected"))
    total = F.col("total_valid") + F.col("total_rejected")
    return agg.select(
        "worst_rate", F.col("total_valid").cast("long").alias("total_valid"),
        F.col("total_rejected").cast("long").alias("total_rejected"),
        F.coalesce(F.try_divide(F.col("total_rejected"), total), F.lit(0.0)).cast("double").alias("overall_rate"),
        (F.col("worst_rate") > F.lit(threshold)).alias("gate_failed"),
    )
