"""Declarative data tests on the star.

* not_null(model, column)         -> failures = NULL rows
* unique(model, column)           -> failures = non-null values seen more than once
* relationships(model, column, to, field)
                                  -> failures = non-null child rows whose value is
                                     absent from the parent (NULL foreign keys pass)

All tests share one aggregation: every tested column of a model becomes
(column, value) rows in one scan of it, counted by value.  Null and repeated
values can be read off these counts, and relationships are one anti join of
the counts with themselves, so that a foreign key holding a third of the child
rows is one row by then.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiffin.session import cut_lineage


@dataclass(frozen=True)
class Test:
    kind: str            # not_null | unique | relationships
    model: str
    column: str
    to: str | None = None
    field: str | None = None

    @property
    def name(self) -> str:
        if self.kind == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to}_{self.field}"
        return f"{self.kind}_{self.model}_{self.column}"


# The primary keys tested not_null + unique, and the 13 foreign keys.
PRIMARY_KEYS = [
    ("dim_restaurant", "restaurant_id"),
    ("dim_location", "location_id"),
    ("dim_cuisine", "cuisine_id"),
    ("dim_customer", "customer_id"),
    ("dim_delivery_partner", "delivery_partner_id"),
    ("dim_date", "date_id"),
    ("dim_time", "hour_id"),
    ("fact_orders", "order_id"),
    ("fact_order_items", "order_item_id"),
    ("fact_deliveries", "delivery_id"),
    ("fact_payments", "payment_id"),
    ("fact_reviews", "review_id"),
]
FOREIGN_KEYS = [
    ("dim_restaurant", "location_id", "dim_location", "location_id"),
    ("bridge_restaurant_cuisine", "restaurant_id", "dim_restaurant", "restaurant_id"),
    ("bridge_restaurant_cuisine", "cuisine_id", "dim_cuisine", "cuisine_id"),
    ("fact_orders", "customer_id", "dim_customer", "customer_id"),
    ("fact_orders", "restaurant_id", "dim_restaurant", "restaurant_id"),
    ("fact_orders", "location_id", "dim_location", "location_id"),
    ("fact_orders", "date_id", "dim_date", "date_id"),
    ("fact_orders", "hour_id", "dim_time", "hour_id"),
    ("fact_order_items", "order_id", "fact_orders", "order_id"),
    ("fact_deliveries", "order_id", "fact_orders", "order_id"),
    ("fact_deliveries", "delivery_partner_id", "dim_delivery_partner", "delivery_partner_id"),
    ("fact_payments", "order_id", "fact_orders", "order_id"),
    ("fact_reviews", "restaurant_id", "dim_restaurant", "restaurant_id"),
]


def star_tests() -> list[Test]:
    tests = []
    for model, col in PRIMARY_KEYS:
        tests.append(Test("not_null", model, col))
        tests.append(Test("unique", model, col))
    tests += [Test("relationships", m, c, to, f) for m, c, to, f in FOREIGN_KEYS]
    return tests


def _known(tests: list[Test] | None, star: dict[str, DataFrame]) -> list[Test]:
    tests = tests if tests is not None else star_tests()
    return [t for t in tests if t.model in star and (t.to is None or t.to in star)]


def key_counts(star: dict[str, DataFrame], tests: list[Test], by: Sequence[str] = ()) -> DataFrame:
    """(column, by, value, rows): how many rows hold each value of every column that a test reads.

    One Expand and aggregation over each model, which is scanned once; a hot
    value is one row per task.  ``column`` is ``model.column``.  Numbers and
    dates are counted as numbers, and written out once they are counted.
    """
    needed: dict[str, set[str]] = {}
    for t in tests:
        needed.setdefault(t.model, set()).add(t.column)
        if t.to is not None:
            needed.setdefault(t.to, set()).add(t.field)
    names = [(m, c) for m, columns in needed.items() for c in sorted(columns)]
    kinds = [star[m].schema[c].dataType for m, c in names]
    text = not all(isinstance(k, (T.IntegralType, T.DateType)) for k in kinds)

    def counted(code: int, column: Column, kind: T.DataType) -> Column:
        number = F.unix_date(column) if isinstance(kind, T.DateType) else column
        plain = isinstance(kind, (T.IntegralType, T.DateType))
        parts = [F.lit(code).alias("code"), (number if plain else F.lit(None)).cast("long").alias("number")]
        return F.struct(*parts, *([(F.lit(None) if plain else column).cast("string").alias("text")] if text else []))
    frames = []
    for model in needed:
        frames.append(star[model].select(*by, F.inline(F.array(*[
            counted(i, F.col(f"`{c}`"), kinds[i]) for i, (m, c) in enumerate(names) if m == model]))))
    keys = ["code", "number", "text"] if text else ["code", "number"]
    counts = reduce(DataFrame.unionByName, frames).groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("rows"))
    dates = [i for i, k in enumerate(kinds) if isinstance(k, T.DateType)]
    number = F.when(F.col("code").isin(*dates), F.date_from_unix_date(F.col("number").cast("int")).cast("string")).otherwise(
        F.col("number").cast("string")) if dates else F.col("number").cast("string")
    value = F.coalesce("text", number) if text else number
    return counts.select(F.get(F.array(*[F.lit(f"{m}.{c}") for m, c in names]), F.col("code")).alias("column"), *by,
                         value.alias("value"), "rows")


def _broken(counts: DataFrame, tests: list[Test], by: Sequence[str] = ()) -> DataFrame:
    """(test_name, by, value, rows): the values that break a test, from ``key_counts``.

    All foreign keys meet all keys in one anti join; both sides hold distinct
    values, so no value is skewed.
    """
    def named(kind: str) -> Column:
        pairs = [(f"{t.model}.{t.column}", t.name) for t in tests if t.kind == kind]
        return F.create_map(*[F.lit(x) for p in pairs for x in p]) if pairs else F.create_map().cast("map<string,string>")
    out = []
    for kind, breaks in (("not_null", F.col("value").isNull()), ("unique", F.col("value").isNotNull() & (F.col("rows") > 1))):
        name = F.try_element_at(named(kind), F.col("column"))
        out.append(counts.where(breaks).select(name.alias("test_name"), *by, "value", "rows").where("test_name IS NOT NULL"))
    targets: dict[str, list[Test]] = {}
    for t in tests:
        if t.kind == "relationships":
            targets.setdefault(f"{t.model}.{t.column}", []).append(t)
    if targets:
        found = F.lit(None).cast("array<struct<test_name:string,key:string>>")
        for column, ts in targets.items():
            found = F.when(F.col("column") == column, F.array(*[
                F.struct(F.lit(t.name).alias("test_name"), F.lit(f"{t.to}.{t.field}").alias("key")) for t in ts])).otherwise(found)
        child = counts.where(F.col("value").isNotNull() & F.col("column").isin(*targets)).select(
            F.inline(found), *by, "value", "rows")
        keys = sorted({f"{t.to}.{t.field}" for t in tests if t.to is not None})
        parent = counts.where(F.col("value").isNotNull() & F.col("column").isin(*keys)).select(
            F.col("column").alias("key"), F.col("value")).distinct()
        out.append(child.join(parent, ["key", "value"], "left_anti").select("test_name", *by, "value", "rows"))
    return reduce(DataFrame.unionByName, out)


def run_tests(star: dict[str, DataFrame], tests: list[Test] | None = None) -> DataFrame:
    """(test_name, test_type, model, column_name, failures, status).

    Every model is read once, whatever the number of tests.  ``failures`` are
    rows for not_null and relationships, repeated values for unique.
    """
    tests = _known(tests, star)
    spark = next(iter(star.values())).sparkSession
    listed = spark.createDataFrame([(t.name, t.kind, t.model, t.column) for t in tests],
                                   "test_name string, test_type string, model string, column_name string")
    broken = _broken(cut_lineage(key_counts(star, tests)), tests).groupBy("test_name").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("values"))
    failures = F.when(F.col("test_type") == "unique", F.col("values")).otherwise(F.col("rows"))
    return listed.join(broken, "test_name", "left").select(
        "test_name", "test_type", "model", "column_name", F.coalesce(failures, F.lit(0)).cast("long").alias("failures")).withColumn(
        "status", F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")))


def failing_rows(star: dict[str, DataFrame], tests: list[Test] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(test_name, by, value, rows) for every failing value of every test, within each ``by`` group."""
    tests = _known(tests, star)
    return _broken(cut_lineage(key_counts(star, tests, by)), tests, by)


def summarize(results: DataFrame) -> DataFrame:
    """Total and passed tests."""
    return results.agg(F.count(F.lit(1)).alias("total_tests"),
                       F.count_if(F.col("status") == "pass").alias("passed_tests"))


def gate(results: DataFrame) -> DataFrame:
    """The summary, and whether it withholds the publish (any test failed)."""
    return summarize(results).withColumn("gate_failed", F.col("passed_tests") < F.col("total_tests"))


def summarize_json(path_df: DataFrame) -> DataFrame:
    """The same summary from a JSON test artefact ``{"results": [{"status": ...}]}``."""
    r = path_df.select(F.explode("results").alias("r"))
    return r.agg(F.count(F.lit(1)).alias("total_tests"),
                 F.count_if(F.col("r.status") == "pass").alias("passed_tests"))
